"""Operators over streams, with state that a checkpoint keeps."""
