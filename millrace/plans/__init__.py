"""Ready-made jobs: plain functions from frames to frames."""
