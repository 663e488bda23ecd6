"""Export profiles, the change store and export runs."""
