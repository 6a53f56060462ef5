"""Reading input tables; storing and restoring what a training run leaves behind."""
