"""Build and explore a catalogue of submitted projects with Spark DataFrames."""
