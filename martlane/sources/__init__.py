"""Sources: topic and change-log readers, and the driver-table fixtures."""
