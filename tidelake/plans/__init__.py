"""What is decided on the driver before a job runs: options, schemas, guards, windows and pruning."""
