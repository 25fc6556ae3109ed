"""The reports: functions from role tables and parameters to one lazy DataFrame."""
