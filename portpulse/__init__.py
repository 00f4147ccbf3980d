"""portpulse: charging-port status logs turned into durations, rates and reports on Spark."""
