"""Term tables, lexicons, word indexes, annotations and semantic profiles as DataFrame-to-DataFrame functions."""
