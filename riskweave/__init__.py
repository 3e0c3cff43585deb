"""Loan-portfolio risk analytics expressed as Spark jobs."""
