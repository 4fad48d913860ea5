"""Sources and sinks: raw pipe files, the derived test feed, the table store."""
