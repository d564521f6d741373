"""What a suite reads, and where its report goes."""
