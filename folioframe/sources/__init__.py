"""Sources and sinks: page rendering, detection, PNG, contract JSON."""
