"""No streaming operators: all inputs are complete tables or files, so every job here is a batch job."""
