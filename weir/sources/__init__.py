"""Readers and writers: CSV records, keyed JSON messages and topics."""
