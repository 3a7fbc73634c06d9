"""DataFrame -> DataFrame operators of the retail model."""
