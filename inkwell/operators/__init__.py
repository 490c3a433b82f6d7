"""Set-oriented operators: each is ``DataFrame -> DataFrame``."""
