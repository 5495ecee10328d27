"""End-to-end jobs: index build and search."""
