"""Row-local features on streaming frames."""
