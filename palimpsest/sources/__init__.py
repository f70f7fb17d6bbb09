"""File formats, record sources and text sinks."""
