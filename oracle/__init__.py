"""Independent DuckDB SQL for every registered query (the correctness oracle).

``MODELS`` holds one SQL body per model (usable as a CTE) and the models it
reads; ``build(name, select)`` assembles ``WITH <adapter>, <models> <select>``
including every model the select needs.  The adapter text is the same one
Spark reads (``fareflow.sources.adapter``).
"""

from oracle.models import MODELS, build, dependencies

__all__ = ["MODELS", "build", "dependencies"]
