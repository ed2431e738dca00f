"""Season models over the raw feed layout: staging, intermediate, facts, marts.

Each model is a DataFrame -> DataFrame function; ``pipeline.build`` wires
them in dependency order from the raw tables.
"""
