"""DataFrame -> DataFrame building blocks of the publishing job."""
