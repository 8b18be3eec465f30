"""Sources: file metadata, routing, and readers of laboratory files as DataFrames."""
