"""Collections and the places their rows come from or go to."""
