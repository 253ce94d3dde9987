"""Raw schemas, readers and table sinks."""
