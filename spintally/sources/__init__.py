"""Where play events and results come from and go to."""
