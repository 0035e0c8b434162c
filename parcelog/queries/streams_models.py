"""Queries of the streaming twins and of the model parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelog import adapters as a
from parcelog.ml import training as t
from parcelog.operators.lifecycle import latest_per_key
from parcelog.operators.summaries import null_counts
from parcelog.queries.lifecycles import O
from parcelog.queries.registry import query, table
from parcelog.storage import materialize, scratch_path
from parcelog.streaming import jobs

c = F.col
L = a.SQL_LISTINGS


def log_stream(spark, sf_dir, parts: int = 1):
    """The sighting log as files of a folder, and a stream over them."""
    path = scratch_path(spark, "log")
    a.observations(spark, sf_dir).select("obs_id", "listing_id", "scraped_at", "price").repartition(parts).write.parquet(path)
    return jobs.source(spark, path, 1), path


def run_stream(spark, sf_dir, cuts: tuple[str, ...] = ("2024-01-11", "2024-01-21")):
    """The sighting log as files of some days each, one after another, and a stream of a batch for each."""
    path, own = scratch_path(spark, "log"), a.observations(spark, sf_dir).select("obs_id", "listing_id", "scraped_at", "price")
    for low, high in zip((None, *cuts), (*cuts, None), strict=True):
        after = c("scraped_at") >= F.lit(low).cast("timestamp_ntz") if low else F.lit(True)
        until = c("scraped_at") < F.lit(high).cast("timestamp_ntz") if high else F.lit(True)
        own.filter(after & until).repartition(1).write.mode("append").parquet(path)
    return jobs.source(spark, path, 1)


query(f"WITH {O} SELECT obs_id, listing_id, scraped_at, price FROM obs WHERE price IS NOT NULL", "stream_ingest")(
    lambda s, d: jobs.ingest(log_stream(s, d, 3)[0], scratch_path(s, "ingest")),
)
query(f"WITH {O} SELECT DISTINCT listing_id FROM obs", "stream_dedupe")(
    lambda s, d: jobs.dedupe(log_stream(s, d, 3)[0].withColumn("scraped_at", c("scraped_at").cast("timestamp")), ["listing_id"], "scraped_at", scratch_path(s, "dedupe")).select("listing_id"),
)
#: Outcomes by going through each listing's sightings one after another; a run is a day.
_STATES = f"""WITH RECURSIVE {O},
o AS (SELECT *, cast(scraped_at AS date) AS run, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at, obs_id) AS rn FROM obs),
s AS (
  SELECT listing_id, obs_id, rn, run, price, price AS known, true AS fresh, false AS repriced, 'new' AS outcome FROM o WHERE rn = 1
  UNION ALL
  SELECT listing_id, obs_id, rn, run, price, CASE WHEN hit THEN price ELSE known END, fresh, hit OR before, CASE WHEN fresh THEN 'dup' WHEN hit THEN 'repriced' ELSE 'known' END
  FROM (SELECT *, NOT fresh AND NOT before AND coalesce(price, 0) <> 0 AND price IS DISTINCT FROM known AS hit
    FROM (SELECT o.listing_id, o.obs_id, o.rn, o.run, o.price, s.known, s.fresh AND s.run = o.run AS fresh, s.repriced AND s.run = o.run AS before
      FROM s JOIN o ON o.listing_id = s.listing_id AND o.rn = s.rn + 1)))"""
query(
    f"""{_STATES} SELECT listing_id, run AS d, coalesce(arg_max(nullif(price, 0), rn) FILTER (WHERE coalesce(price, 0) <> 0), max(known)) AS price
    FROM s GROUP BY 1, 2 HAVING bool_and(outcome = 'known') AND coalesce(max(nullif(price, 0)), max(known)) IS NOT NULL""",
    "stream_presence",
)(lambda s, d: jobs.presence(run_stream(s, d), scratch_path(s, "presence")))
query(f"WITH {O} SELECT start, count(*) AS n FROM (SELECT unnest(list_transform(range(0, 12), lambda i: to_timestamp(floor(epoch(scraped_at) / 5) * 5 - i * 5)::timestamp)) AS start FROM obs) GROUP BY 1", "stream_rate")(
    lambda s, d: jobs.rate(log_stream(s, d, 2)[0].withColumn("scraped_at", c("scraped_at").cast("timestamp")), "scraped_at", scratch_path(s, "rate")).select(c("start").cast("timestamp_ntz").alias("start"), "n"),
)
query(f"{_STATES} SELECT obs_id, outcome FROM s", "stream_card_state")(
    lambda s, d: jobs.card_states(run_stream(s, d), scratch_path(s, "states")).select("obs_id", "outcome"),
)


@query(f"WITH {O} SELECT obs_id FROM obs WHERE price IS NOT NULL")
def stream_checkpoint(spark, sf_dir):
    """Half of the log, a stop, the other half: each row arrives once."""
    path, folder = scratch_path(spark, "log"), scratch_path(spark, "resumed")
    own = a.observations(spark, sf_dir).select("obs_id", "listing_id", "scraped_at", "price")
    own.filter("obs_id % 2 = 0").write.parquet(path)
    jobs.ingest(jobs.source(spark, path), folder)
    own.filter("obs_id % 2 = 1").write.mode("append").parquet(path)
    return jobs.ingest(jobs.source(spark, path), folder).select("obs_id")


@query(f"WITH {O} SELECT max(scraped_at) AS newest FROM obs WHERE price IS NOT NULL HAVING max(scraped_at) < timestamp '2024-01-31 20:00:00' - INTERVAL 14 HOUR")
def stream_freshness(spark, sf_dir):
    from parcelog.operators.checks import stale

    return stale(
        jobs.ingest(log_stream(spark, sf_dir, 2)[0], scratch_path(spark, "fresh")),
        "scraped_at",
        F.lit("2024-01-31 20:00:00").cast("timestamp_ntz"),
        14,
    )


_SHARE = lambda x: f"(cast('0x' || substr(md5({x}), 1, 8) AS bigint) / 4294967296.0::double)"
query(f"WITH {L} SELECT listing_id, row_number() OVER (PARTITION BY status ORDER BY md5('0|' || listing_id), listing_id) <= floor(0.2 * count(*) OVER (PARTITION BY status) + 0.5) AS is_test FROM listings", "stratified_split")(
    lambda s, d: t.stratified_split(a.listings(s, d), "listing_id", "status", 0.2).select("listing_id", "is_test")
)
query(f"WITH {L} SELECT listing_id, cast(dense_rank() OVER (ORDER BY segment) - 1 AS int) AS index FROM listings", "label_encode")(
    lambda s, d: t.label_index(a.listings(s, d), "segment").select("listing_id", "index"),
)
_TE = f"""WITH {L}, x AS (SELECT listing_id, municipality, cast(price > 250000 AS int) AS y, cast(floor({_SHARE('cast(listing_id AS varchar)')} * 5) AS int) AS fold FROM listings),
  f AS (SELECT municipality, fold, sum(y)::double AS s, count(y) AS m FROM x GROUP BY 1, 2), g AS (SELECT municipality, fold, sum(s) OVER (PARTITION BY municipality) - s AS s_, sum(m) OVER (PARTITION BY municipality) - m AS m_, (sum(s) OVER () - sum(s) OVER (PARTITION BY fold)) / (sum(m) OVER () - sum(m) OVER (PARTITION BY fold)) AS p_ FROM f)
  SELECT listing_id, round((s_ + 10 * p_) / (m_ + 10), 6) AS encoded FROM x JOIN g USING (municipality, fold)"""
query(_TE, "target_encode")(
    lambda s, d: t.target_encode(a.listings(s, d).withColumn("y", (c("price") > 250000).cast("int")), "municipality", "y", "listing_id").select("listing_id", F.round("encoded", 6).alias("encoded")),
)
_SCORED = f"WITH {L}, x AS (SELECT cast(status = 'O' AS int) AS y, round(price / 500000, 6) AS s, price / 500000 AS raw FROM listings), b AS (SELECT s, sum(y) AS p, count(*) AS n, sum(cast(y = cast(raw >= 0.5 AS int) AS int)) AS ok FROM x GROUP BY 1), w AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS al FROM b)"
query(f"{_SCORED} SELECT round(sum((n - p) * (tp - p / 2)) / (sum(p) * sum(n - p)), 6) AS roc_auc, round(sum(p * tp / al) / sum(p), 6) AS average_precision, round(sum(ok) / sum(n), 6) AS accuracy, cast(sum(n) AS bigint) AS n FROM w", "clf_metrics")(
    lambda s, d: t.classifier_metrics(a.listings(s, d).select((c("status") == "O").cast("int").alias("y"), (c("price") / 500000).alias("score")), "y"),
)
query(f"WITH {L}, x AS (SELECT price AS y, area * 4000 AS z FROM listings) SELECT round(avg(abs(y - z)), 4) AS mae, round(sqrt(avg((y - z) * (y - z))), 4) AS rmse, round(1 - sum((y - z) * (y - z)) / (var_pop(y) * count(y)), 4) AS r2 FROM x", "reg_metrics")(
    lambda s, d: t.regression_metrics(a.listings(s, d).select(c("price").alias("y"), (c("area") * 4000).alias("z")), "y", "z"),
)
query(f"WITH {L}, x AS (SELECT price AS y, round(ppm2) * area AS z FROM listings) SELECT round(avg(abs(y - z)), 4) AS mae, round(sqrt(avg((y - z) * (y - z))), 4) AS rmse, round(1 - sum((y - z) * (y - z)) / (var_pop(y) * count(y)), 4) AS r2 FROM x", "price_restore")(
    lambda s, d: t.regression_metrics(a.listings(s, d).select(c("price").alias("y"), (F.round("ppm2") * c("area")).alias("z")), "y", "z"),
)
query(f"WITH {L} SELECT status = 'O' AS label, price >= 250000 AS predicted, count(*) AS n FROM listings GROUP BY 1, 2", "confusion")(
    lambda s, d: t.confusion(a.listings(s, d).select((c("status") == "O").alias("label"), (c("price") >= 250000).alias("predicted")), "label", "predicted"),
)


@query(f"WITH {L} SELECT unnest(['price', 'region', 'rooms', 'is_new']) AS feature, unnest([true, false, true, false]) AS numeric, unnest([count(DISTINCT price), count(DISTINCT region), count(DISTINCT rooms), count(DISTINCT is_new)]) AS n_values FROM listings")
def split_cols_by_type(spark, sf_dir):
    """Columns by kind, with how many values each has."""
    own = a.listings(spark, sf_dir).select("price", "region", "rooms", "is_new")
    numeric, _ = t.columns_by_type(own)
    counts = null_counts(own)
    return counts.select("feature", c("feature").isin(numeric).alias("numeric"), c("distinct").alias("n_values"))


NUMBERS, CATEGORIES = ["area", "rooms", "lat", "lon"], ["region", "segment"]


def labelled(spark, sf_dir):
    return a.listings(spark, sf_dir).withColumns(
        {"y": (c("ppm2") > 4500).cast("int"), "lat": c("lat").cast("double"), "lon": c("lon").cast("double"), "rooms": c("rooms").cast("double")},
    )


def _scored(kind: str, label: str):
    def run(spark, sf_dir):
        data = labelled(spark, sf_dir)
        return t.score(
            t.fit(data.filter(t.hash_share("listing_id") >= 0.2), kind, label, NUMBERS, CATEGORIES),
            data.filter(t.hash_share("listing_id") < 0.2),
            "listing_id",
            label,
        )

    return run


query(None, "clf_boosted")(lambda s, d: t.classifier_metrics(_scored("clf_boosted", "y")(s, d), "y"))


@query(None)
def simple_models(spark, sf_dir):
    """Two models on features that are fitted and written once for both."""
    data = materialize(labelled(spark, sf_dir).select("listing_id", "y", *NUMBERS, *CATEGORIES), "labelled")
    train = data.filter(t.hash_share("listing_id") >= 0.2)
    prepared = t.Pipeline(stages=t.preprocessor(NUMBERS, CATEGORIES)).fit(train)
    known, others = (materialize(prepared.transform(x).select("y", "features"), "prepared") for x in (train, data.filter(t.hash_share("listing_id") < 0.2)))
    logistic, tree = (t.classifier_metrics(t.score(t.MODELS[kind]("y").fit(known), others, "y"), "y").withColumn("model", F.lit(kind)) for kind in ("logistic", "tree"))
    return logistic.union(tree)


query(None, "reg_boosted")(lambda s, d: t.regression_metrics(_scored("reg_boosted", "ppm2")(s, d), "ppm2", "score"))
query(None, "importances")(lambda s, d: t.importances(t.fit(labelled(s, d), "clf_boosted", "y", NUMBERS, CATEGORIES), labelled(s, d)))
query(None, "ohe_scale")(
    lambda s, d: (lambda data: t.Pipeline(stages=t.preprocessor(NUMBERS, CATEGORIES)).fit(data).transform(data).select("listing_id", t.vector_to_array("features").alias("features")))(labelled(s, d)),
)
#: What the random search draws from: a logistic regression and a tree.
SPACES = [{"model": ["logistic"], "regParam": [0.01, 0.1, 1.0]}, {"model": ["tree"], "maxDepth": [3, 5], "minInstancesPerNode": [20, 50]}]


@query(None)
def random_search_cv(spark, sf_dir):
    found = t.random_search(labelled(spark, sf_dir), "listing_id", "y", NUMBERS, CATEGORIES, SPACES, n=4)
    return spark.createDataFrame([(i, float(area), str(setting)) for i, (area, setting) in enumerate(found, 1)], "place int, roc_auc double, setting string")


query(None, "batch_score")(
    lambda s, d: (lambda data: t.score(t.fit(data, "clf_boosted", "y", NUMBERS, CATEGORIES), latest_per_key(data.filter("status = 'O'"), "seller_id", c("first_seen"), c("listing_id")), "seller_id", "listing_id", "ppm2"))(labelled(s, d)),
)


@query(None)
def model_meta(spark, sf_dir):
    """Metrics on the newest fifth of a model that is then fitted on all rows, saved and loaded again."""
    path = scratch_path(spark, "model")
    model, metrics = t.train_with_holdout(labelled(spark, sf_dir), "tree", "y", "listing_id", "first_seen", NUMBERS, CATEGORIES)
    model.write().overwrite().save(path)
    features = len(t.PipelineModel.load(path).stages[0].getInputCols()) + len(CATEGORIES)
    return metrics.withColumn("n_features", F.lit(features))


query(None, "q_model_meta")(model_meta)
