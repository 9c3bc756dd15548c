"""DataFrame-in, DataFrame-out operators. None of them starts a job."""
