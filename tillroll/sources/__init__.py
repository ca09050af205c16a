"""Reading raw invoice lines, and recording what was read."""
