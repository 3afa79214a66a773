"""Reading landing files, writing layers."""
