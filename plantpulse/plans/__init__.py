"""Domain reports: alarms, machine state, production, weighing, usage."""
