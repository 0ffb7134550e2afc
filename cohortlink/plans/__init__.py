"""The three jobs users run: participant mapping, roster sync and research submission."""
