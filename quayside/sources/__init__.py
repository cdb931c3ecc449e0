"""Readers. Each turns files into one or more frames of mostly string columns."""
