"""The registered queries: each runs an operator over whole given tables.

A module defines ``QUERIES``: name -> (callable(spark, sf_dir), SQL over the
original tables or None). Inputs are message logs that Spark builds from the
given tables; the SQL never sees them.
"""

from rowlake.queries import decoding, evolution, flows, lake, naming, rdbms, shaping, typing

MODULES = (decoding, naming, shaping, typing, lake, evolution, rdbms, flows)
QUERIES = {name: entry for module in MODULES for name, entry in module.QUERIES.items()}
