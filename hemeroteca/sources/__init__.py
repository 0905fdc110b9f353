"""Reading and writing corpora: JSON, CSV, checkpoints, snapshots."""
