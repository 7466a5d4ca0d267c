"""The narrow stages on a growing folder."""
