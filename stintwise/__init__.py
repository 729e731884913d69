"""stintwise: career-history analytics and graph preparation on Spark.

Every public function takes and returns DataFrames; nothing is collected to
the driver.  Modules:

* ``stintwise.operators.careers``   debuts, retirements, transfers, gaps, breaks
* ``stintwise.operators.normalise`` child tables, dense ids, chains, season flatten
* ``stintwise.operators.schema``    key discovery and record projection
* ``stintwise.operators.graph``     node/edge tables, merge, batches, import layout
* ``stintwise.sources``             YAML documents, CSV tables, test bindings
* ``stintwise.plans``               end-to-end build (``build_all``), SQL views, query registry
* ``stintwise.streaming``           incremental season ingest
"""

from stintwise.session import cluster_conf, local_session, materialize, scratch_path

__all__ = ["cluster_conf", "local_session", "materialize", "scratch_path"]
