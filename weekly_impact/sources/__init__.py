"""Sources and sinks: event scan, literal dimensions, result writers, test-table adapters."""
