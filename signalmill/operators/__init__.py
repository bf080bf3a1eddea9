"""Pure functions from DataFrame to DataFrame; none of them starts a job."""
