"""tessera: a DataFrame-first analytics library on PySpark.

Three workloads, each built from plain DataFrame operators:

* web-server log analytics (``operators.logs``)
* text analysis and entity resolution (``operators.text``, ``operators.resolution``)
* rating statistics and ALS recommendations (``operators.ratings``)

plus the general relational operators beneath them (``operators.relational``).
"""

from tessera.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
