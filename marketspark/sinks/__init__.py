"""Layer writers and table maintenance."""
