"""Query plans over the driver tables and their independent SQL oracle."""
