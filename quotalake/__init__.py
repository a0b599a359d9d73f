"""quotalake: sales and pipeline analytics on a star schema, as Spark DataFrame operators.

Modules:

* ``sources``   -- table access and the star (roles mapped onto the driver tables,
  ``Star.materialize`` for a once-built, priced fact);
* ``functions`` -- column expressions: exact decimal rounding, deterministic draws,
  calendar attributes, names;
* ``operators`` -- reports and views, data-building operators, distributed k-th
  pick / territory assignment, integrity audits;
* ``plans``     -- the query registry and its independent SQL oracle;
* ``streaming`` -- intentionally empty (no streaming surface to rebuild).
"""

from quotalake.sources.star import MaterializedStar, Star, StarConfig

__all__ = ["MaterializedStar", "Star", "StarConfig"]
