"""harrow: harvest, merge and clean funding listings with Spark DataFrames.

Layers, lowest first:

* ``schema``     canonical columns and null tokens
* ``functions``  ``Column -> Column`` text, extraction, classification and scoring rules
* ``operators``  ``DataFrame -> DataFrame`` steps: conform, keep-first, filter, report, page harvest
* ``sources``    feed files in, cleaned tables and reports out
* ``plans``      the end-to-end chains (clean loans, clean scholarships, ingest and merge)
* ``streaming``  the row-wise part of the clean chains over a stream
"""
