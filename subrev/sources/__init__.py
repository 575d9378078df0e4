"""File sources and sinks, and the adapters from the driver tables to the five entities."""
