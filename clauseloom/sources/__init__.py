"""Readers and writers: loan files, regulation text, rule packs, verdicts."""
