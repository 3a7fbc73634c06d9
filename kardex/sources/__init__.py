"""Source readers (files) and the test-table bindings (testdata)."""
