"""Fixed rules of the offer domain. Operators take them as parameters with these as defaults."""
