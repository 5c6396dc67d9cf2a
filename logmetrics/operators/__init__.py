"""``DataFrame -> DataFrame`` steps on log lines, entries, timelines and trips."""
