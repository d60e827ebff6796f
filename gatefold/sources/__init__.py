"""File sources and sinks: event files, metadata tables, configuration, gate export."""
