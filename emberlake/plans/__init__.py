"""Jobs over the lake and the daily chain."""
