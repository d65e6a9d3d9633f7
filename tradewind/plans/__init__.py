"""The twenty-two business questions, their variants, parameters and sweeps."""
