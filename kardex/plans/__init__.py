"""Model building, the analytics run and the batch job."""
