"""Tables, sheet-shaped grids and their sinks."""
