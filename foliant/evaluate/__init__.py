"""Quality checks of harmonised values."""
