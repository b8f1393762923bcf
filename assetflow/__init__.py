"""assetflow: asset-telemetry analytics on PySpark.

Readings -> hourly windows -> change log (upsert / change feed) -> enriched gold
-> features (age, remaining life, look-ahead label) -> per-asset models ->
operating-point sweep and profit, all expressed with the DataFrame API.

Where to start:

* ``assetflow.session.build_session`` / ``scale_settings``: a configured session.
* ``assetflow.sources.landing``: files of any width in one landing folder; ``sources.files``: idempotent loads.
* ``assetflow.streaming.Medallion``: the bronze -> silver -> gold streams
  (also ``python -m assetflow.streaming``).
* ``assetflow.operators.aggregate`` / ``enrich`` / ``features``: window means,
  gold readings, two-way as-of age, row and time look-ahead labels.
* ``assetflow.operators.keyed``: keyed tables by date with deletes and a typed feed;
  ``operators.changelog``: the plain append-only log.
* ``assetflow.operators.trees``: boosted trees of every asset at once.
* ``assetflow.operators.models``: ``fit`` / ``score`` (per-group ridge from
  sufficient statistics), ``run_log``, ``best_runs``, ``registry_stages``,
  ``fit_trees``, ``usage_clusters``.
* ``assetflow.operators.scenario``: sweep grid, profit, optimum, fleet KPIs.
* ``assetflow.operators.layout``: compaction and clustering of closed partitions.
* ``assetflow.plans.catalog.QUERIES``: every registered analytic by name.
"""

__version__ = "0.1.0"
