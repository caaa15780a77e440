"""Readers and writers for posts and result documents."""
