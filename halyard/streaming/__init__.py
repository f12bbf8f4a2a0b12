"""Streaming: files as they arrive, merged by key, and windowed counts with a watermark."""
