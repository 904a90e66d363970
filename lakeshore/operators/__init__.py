"""DataFrame -> DataFrame operators. None of them touches storage."""
