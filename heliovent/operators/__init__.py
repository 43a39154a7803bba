"""DataFrame -> DataFrame operators; all lazy, none triggers a job."""
