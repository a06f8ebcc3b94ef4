"""Readers, file families and writers. All paths are Hadoop URIs."""
