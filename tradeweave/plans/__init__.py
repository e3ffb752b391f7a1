"""End-to-end jobs: load, detailed report, summaries, retention."""
