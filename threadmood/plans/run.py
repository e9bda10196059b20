"""Train, score and report per target, skipping what is already there."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmood import schemas
from threadmood.functions import text
from threadmood.operators import (
    features,
    filters,
    joins,
    labels,
    models,
    postings,
    reports,
    sampling,
    scoring,
    spread,
)
from threadmood.plans.config import TARGETS, VECTORIZER_PATH, TargetConfig
from threadmood.session import pin, shuffles_freed
from threadmood.sources import paths, readers, writers
from threadmood.sources.made_of import chained, of_frame


@dataclass(frozen=True)
class Inputs:
    comments: DataFrame
    stories: DataFrame
    labels: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.comments.sparkSession

    @cached_property
    def labelled_from(self) -> str:
        """What labelled comments are made of; see made_of."""
        return chained(of_frame(self.comments), of_frame(self.labels))

    @cached_property
    def joined_from(self) -> str:
        """What comments with their stories are made of."""
        return chained(of_frame(self.comments), of_frame(self.stories))


def load_inputs(spark: SparkSession, comments: str, stories: str, label_csv: str) -> Inputs:
    pin(spark)
    return Inputs(
        readers.read_parquet(spark, comments),
        readers.read_parquet(spark, stories),
        readers.read_labels(spark, label_csv),
    )


#: Terms up to which vocabulary and models are MLlib's, which the driver holds; more are kept in buckets (``spread``).
ON_DRIVER = 1 << 17

VOCABULARY, KEYS, SPREAD = "vocabulary.parquet", "keys.parquet", "spread"
LABELLED, TRAINING, SAMPLED, SCORED, REPORTS = (
    "labelled.parquet",
    "training.parquet",
    "sampled.parquet",
    "scored.parquet",
    "reports.parquet",
)


def labelled_extract(inputs: Inputs, out_dir: str) -> DataFrame:
    """Tokens, labels and weights of the labelled comments: one scan of the bodies for fit and training.

    What is stored is the words; their n-grams are several times as large and are made where they are read.
    """
    rows = labels.training_rows(inputs.comments, inputs.labels).withColumn("words", text.words(F.col("body"))).drop("body")
    stored = writers.materialize(rows, posixpath.join(out_dir, LABELLED), chained(inputs.labelled_from, "words"), compression="zstd")
    return stored.withColumn("tokens", text.ngrams_of(F.col("words"))).drop("words")


def vocabulary_table(inputs: Inputs, out_dir: str) -> DataFrame:
    """(term, documents) of the labelled comments, stored."""
    path = posixpath.join(out_dir, VOCABULARY)
    if writers.is_current(inputs.spark, path, inputs.labelled_from):
        return inputs.spark.read.parquet(path)
    terms = features.vocabulary(labels.repeated(labelled_extract(inputs, out_dir)))
    return writers.materialize(terms, path, inputs.labelled_from)


@dataclass(frozen=True)
class Lookup:
    """A vocabulary in buckets of hashes, of any size."""

    keys: DataFrame
    buckets: int
    features: int
    made_of: str

    @property
    def fits_driver(self) -> bool:
        return self.features <= ON_DRIVER


def lookup(inputs: Inputs, out_dir: str) -> Lookup:
    terms = vocabulary_table(inputs, out_dir)
    count = terms.agg(F.count("*").alias("terms"), F.coalesce(F.sum("documents"), F.lit(0)).alias("occurrences")).first()
    buckets = postings.buckets_for(count.occurrences)
    made_of = chained(inputs.labelled_from, "buckets", buckets)
    keys = writers.materialize(postings.vocabulary_buckets(terms, buckets), posixpath.join(out_dir, KEYS), made_of)
    return Lookup(keys, buckets, count.terms, made_of)


def spread_models(inputs: Inputs, configs: tuple[TargetConfig, ...], found: Lookup, out_dir: str) -> "Spread":
    """All models of the targets, fitted in step over the stored labelled comments."""
    spark = inputs.spark
    home = posixpath.join(out_dir, SPREAD, "-".join(c.name for c in configs))
    fits = [fit for c in configs for fit in spread.fits_of(c.name, c.label_col, c.folds, c.seed)]
    made_of = chained(found.made_of, fits)
    done = posixpath.join(home, "models")
    if not writers.is_current(spark, done, made_of):
        written = []

        def store(df: DataFrame, name: str) -> DataFrame:
            written.append(name)
            path = posixpath.join(home, name)
            paths.remove(spark, path)
            return writers.materialize(df, path, made_of)

        rows = spread.with_roles(labelled_extract(inputs, out_dir), fits)
        blobs = postings.cut(rows, ["weight", "learn", "judge", "flag"], "tokens", found.buckets)
        spread.trained(fits, found.keys, blobs, found.buckets, found.features, store, lambda name: paths.remove(spark, posixpath.join(home, name)))
        for name in written:
            if name not in ("weights", "margins", "models"):
                paths.remove(spark, posixpath.join(home, name))
    return Spread(spark, home, found, made_of)


@dataclass(frozen=True)
class Spread:
    """Stored models over a vocabulary in buckets."""

    spark: SparkSession
    home: str
    lookup: Lookup
    made_of: str

    @cached_property
    def known(self) -> list[dict]:
        return spread.read_models(self.spark, posixpath.join(self.home, "models"))

    def model(self, target: str, polarity: models.Polarity) -> dict:
        return next(m for m in self.known if (m["target"], m["polarity"], m["fold"]) == (target, polarity.name, None))

    def folds(self, target: str, polarity: models.Polarity) -> list[dict]:
        return [m for m in self.known if (m["target"], m["polarity"]) == (target, polarity.name) and m["fold"] is not None]

    def margins(self, model: dict) -> DataFrame:
        """(margin, label, weight) of the rows a model is judged on."""
        judged = self.spark.read.parquet(posixpath.join(self.home, "margins"))
        return judged.where(F.col("fit") == model["fit"]).select("margin", "label", "weight")

    @property
    def weights(self) -> DataFrame:
        return self.spark.read.parquet(posixpath.join(self.home, "weights"))

    def scored(self, rows: DataFrame, carry: list[str], tokens: str = "tokens", weights: DataFrame | None = None) -> DataFrame:
        """Carried columns, ``nonzeros`` and ``margins`` of rows in stable order."""
        blobs = postings.cut(rows, carry, tokens, self.lookup.buckets)
        count = sum(m["place"] is not None for m in self.known)
        return postings.scored(self.weights if weights is None else weights, blobs, self.lookup.buckets, count)


def numbered(rows: DataFrame, path: str, made_of: str | None = None) -> DataFrame:
    """Rows with a number of their own, stored: they come in the same order whenever they are read."""
    return writers.materialize(rows.withColumn("row", F.monotonically_increasing_id()), path, made_of)


def scored_spread(rows: DataFrame, trained: Spread, targets: Iterable[str], path: str, made_of: str | None = None) -> DataFrame:
    """Stored rows of ``numbered`` with ``<target>_pos`` and ``<target>_neg``."""
    margins = trained.scored(features.with_tokens(rows), ["row"])
    flags = {
        f"{name}_{p.name}": spread.decisions("margins", trained.model(name, p), p)[1] for name in targets for p in models.POLARITIES
    }
    flagged = rows.join(margins.select("row", *(flag.alias(name) for name, flag in flags.items())), "row").drop("row")
    return writers.materialize(flagged, path, made_of)


def vectorizer_tie(inputs: Inputs, out_dir: str) -> tuple[str, str]:
    """Where the vectorizer's makings are kept, and what they are now."""
    return posixpath.join(out_dir, f"{VECTORIZER_PATH}.made_of"), inputs.labelled_from


def vectorizer(inputs: Inputs, out_dir: str) -> CountVectorizerModel:
    """The shared vectorizer, fitted on the labelled comments unless saved before for the same inputs."""
    path = posixpath.join(out_dir, VECTORIZER_PATH)

    def fit() -> dict:
        return {path: features.vectorizer_of(vocabulary_table(inputs, out_dir))}

    writers.fit_unless_saved(inputs.spark, {path: features.VECTORIZER_MARKER}, fit, vectorizer_tie(inputs, out_dir))
    return features.load_vectorizer(path)


def training_frame(inputs: Inputs, model: CountVectorizerModel, path: str) -> DataFrame:
    """Vectors and label columns of the labelled comments, stored for the many fits.

    Every iteration of every fit is a job over these files, so they are made even and
    no smaller than a task is worth.
    """
    rows = labelled_extract(inputs, posixpath.dirname(path))
    frame = features.vectorize(rows, model).drop("copies", "tokens")
    return writers.materialize(frame.hint("rebalance"), path, chained(inputs.labelled_from, features.fingerprint(model)))


def models_from(inputs: Inputs, config: TargetConfig, model: CountVectorizerModel | Lookup) -> str:
    """What the models of a target are made of: the labelled comments, the vocabulary and the settings of training."""
    vocabulary = model.made_of if isinstance(model, Lookup) else features.fingerprint(model)
    return chained(inputs.labelled_from, vocabulary, config.label_col, config.folds, config.seed)


def models_tie(inputs: Inputs, config: TargetConfig, model: CountVectorizerModel, out_dir: str) -> tuple[str, str]:
    """Where the makings of a target's models are kept, and what they are now."""
    return posixpath.join(out_dir, config.model_dir, "made_of"), models_from(inputs, config, model)


def scored_from(inputs: Inputs, config: TargetConfig, model: CountVectorizerModel | Lookup) -> str:
    """What the scored rows of a target, and its reports, are made of."""
    sample = config.sample_fraction, config.bernoulli, config.seed if config.bernoulli else None
    return chained(inputs.joined_from, models_from(inputs, config, model), *sample)


def trained_models(
    inputs: Inputs,
    config: TargetConfig,
    model: CountVectorizerModel,
    out_dir: str,
    frame_path: str,
) -> dict[str, CrossValidatorModel]:
    """Both models of a target; if either is missing, or made of something else, both are trained.

    The training table goes to ``frame_path`` unless another target has put it there.
    """
    path_of = {
        p.name: posixpath.join(out_dir, config.model_dir, f"{p.name}.model")
        for p in models.POLARITIES
    }

    def fit() -> dict:
        frame = training_frame(inputs, model, frame_path)
        pair = models.train_pair(
            labels.binarize(frame, config.label_col), config.folds, config.seed
        )
        return {path_of[name]: fitted for name, fitted in pair.items()}

    tie = models_tie(inputs, config, model, out_dir)
    writers.fit_unless_saved(
        inputs.spark, {path: models.MODEL_MARKER for path in path_of.values()}, fit, tie
    )
    return {name: models.load_model(path) for name, path in path_of.items()}


def trained_pairs(
    inputs: Inputs, configs: tuple[TargetConfig, ...], model: CountVectorizerModel, out_dir: str, frame_path: str
) -> dict[str, dict[str, CrossValidatorModel]]:
    """The models of all targets, trained at once: their fits are small jobs over one stored frame."""
    spark = inputs.spark
    markers = [posixpath.join(out_dir, c.model_dir, f"{p.name}.model", models.MODEL_MARKER) for c in configs for p in models.POLARITIES]
    if not all(paths.exists(spark, marker) for marker in markers):
        training_frame(inputs, model, frame_path)  # stored ahead, for all to read

    @inheritable_thread_target(spark)
    def one(config: TargetConfig) -> dict[str, CrossValidatorModel]:
        return trained_models(inputs, config, model, out_dir, frame_path)

    with ThreadPool(max(1, len(configs))) as pool:
        return dict(zip([c.name for c in configs], pool.map(one, configs), strict=True))


def _sampled(inputs: Inputs, config: TargetConfig) -> DataFrame:
    if config.bernoulli:
        return sampling.bernoulli_sample(inputs.comments, config.sample_fraction, config.seed)
    return sampling.stable_sample(inputs.comments, config.sample_fraction)


def sampled_rows(inputs: Inputs, fraction: float, path: str) -> DataFrame:
    """Eligible comments of a stable sample with their stories, stored.

    Smaller stable samples are part of it, so several targets need one scan and one join.
    """
    sampled = filters.eligible(sampling.stable_sample(inputs.comments, fraction))
    rows = joins.comment_story(sampled, inputs.stories, keys=inputs.comments)
    return numbered(rows, path, chained(inputs.joined_from, fraction))


def scored_by_all(
    rows: DataFrame,
    model: CountVectorizerModel,
    pairs: dict[str, dict[str, CrossValidatorModel]],
    path: str,
    made_of: str | None = None,
) -> DataFrame:
    """The rows with ``<target>_pos`` and ``<target>_neg`` of each target, stored: one tokenisation for all."""
    vectors = features.vectorize(features.with_tokens(rows), model)
    for name, pair in pairs.items():
        vectors = scoring.apply_models(vectors, pair, prefix=f"{name}_")
    flags = [f"{name}_{polarity.name}" for name in pairs for polarity in models.POLARITIES]
    return writers.materialize(vectors.select(*rows.drop("row").columns, *flags), path, made_of)


def scored_table(
    inputs: Inputs,
    config: TargetConfig,
    model: CountVectorizerModel | Lookup,
    pair: dict[str, CrossValidatorModel] | Spread,
    out_dir: str,
    shared: DataFrame | None = None,
) -> DataFrame:
    """The frozen rows every report of the target reads.

    The sample is taken from the comments, ahead of the join to the stories: the rows
    left out are neither tokenised nor shuffled. ``shared`` may hold the rows of this and
    other targets, scored by all.
    """
    if shared is not None:
        rows = sampling.stable_sample(shared, config.sample_fraction)
        scored = rows.withColumns({p.name: F.col(f"{config.name}_{p.name}") for p in models.POLARITIES})
    elif isinstance(pair, Spread):
        made_of = scored_from(inputs, config, model)
        if writers.is_current(inputs.spark, posixpath.join(out_dir, config.scored_path), made_of):
            return inputs.spark.read.parquet(posixpath.join(out_dir, config.scored_path))
        own = [posixpath.join(out_dir, config.model_dir, name) for name in (SAMPLED, SCORED)]
        joined = joins.comment_story(filters.eligible(_sampled(inputs, config)), inputs.stories, keys=inputs.comments)
        rows = scored_spread(numbered(joined, own[0], made_of), pair, (config.name,), own[1], made_of)
        scored = rows.withColumns({p.name: F.col(f"{config.name}_{p.name}") for p in models.POLARITIES})
        shown = scored.select(*schemas.SCORED.names)
        stored = writers.materialize(shown, posixpath.join(out_dir, config.scored_path), made_of)
        for path in own:
            paths.remove(inputs.spark, path)
        return stored
    else:
        rows = _sampled(inputs, config)
        scored = scoring.score(rows, inputs.stories, model, pair, keys=inputs.comments)
    return writers.materialize(
        scored.select(*schemas.SCORED.names), posixpath.join(out_dir, config.scored_path), scored_from(inputs, config, model)
    )


def write_reports(scored: DataFrame, config: TargetConfig, out_dir: str, made_of: str | None = None) -> dict[str, str]:
    """Report name to path. All reports come from one pass over the scored rows; those made of the same are left alone."""
    spark = scored.sparkSession
    path_of = {name: posixpath.join(out_dir, path) for name, path in config.reports.items()}
    missing = [name for name, path in path_of.items() if not writers.is_current(spark, path, made_of)]
    if missing:
        keyed = tuple(name for name in missing if schemas.REPORT_KEYS[name])
        staged = posixpath.join(out_dir, config.model_dir, REPORTS)
        whole = reports.keyed_reports(scored, keyed, "overall" in missing) if keyed else None
        stored = None if whole is None else writers.materialize(whole, staged, made_of and chained(made_of, *missing))
        for name in missing:
            if stored is None:
                report = reports.report(scored, name, ordered=False)
            else:
                key = schemas.REPORT_KEYS[name]
                own = [key.name] if key else []
                report = stored.where(F.col("report") == name).select(*own, "percent_pos", "percent_neg")
            writers.write_report(report, path_of[name], config.single_file, made_of)
        paths.remove(spark, staged)
    return path_of


def run_targets(
    inputs: Inputs, out_dir: str, configs: Iterable[TargetConfig] = tuple(TARGETS.values())
) -> dict[str, dict[str, str]]:
    """All stages of all targets; returns target to report name to path.

    Intermediate tables lie at fixed places under ``out_dir``, so a run that was cut off finds
    them; they are removed at the end. What a table's job has shuffled goes when the table is stored.
    """
    with shuffles_freed(inputs.spark):
        return _run_targets(inputs, out_dir, tuple(configs))


def _run_targets(inputs: Inputs, out_dir: str, configs: tuple[TargetConfig, ...]) -> dict[str, dict[str, str]]:
    spark = inputs.spark
    found = lookup(inputs, out_dir)
    frame_path = posixpath.join(out_dir, TRAINING)
    if found.fits_driver:
        model = vectorizer(inputs, out_dir)
        pairs = trained_pairs(inputs, configs, model, out_dir, frame_path)
    else:
        model = found
        pairs = dict.fromkeys([c.name for c in configs], spread_models(inputs, configs, found, out_dir))
    made_of = {c.name: scored_from(inputs, c, model) for c in configs}
    sharing = [
        c
        for c in configs
        if not c.bernoulli and not writers.is_current(spark, posixpath.join(out_dir, c.scored_path), made_of[c.name])
    ]
    shared = None
    shared_paths = []
    if len(sharing) > 1:
        largest = max(c.sample_fraction for c in sharing)
        names = "-".join(sorted(c.name for c in sharing))
        shared_paths = [posixpath.join(out_dir, f"{names}-{largest}", name) for name in (SAMPLED, SCORED)]
        rows = sampled_rows(inputs, largest, shared_paths[0])
        scored_of = chained(*(made_of[c.name] for c in sharing))
        if found.fits_driver:
            shared = scored_by_all(rows, model, {c.name: pairs[c.name] for c in sharing}, shared_paths[1], scored_of)
        else:
            trained = pairs[sharing[0].name]
            shared = scored_spread(rows, trained, [c.name for c in sharing], shared_paths[1], scored_of)
    written = {}
    for config in configs:
        scored = scored_table(
            inputs, config, model, pairs[config.name], out_dir,
            shared if config in sharing else None,
        )
        written[config.name] = write_reports(scored, config, out_dir, made_of[config.name])
    for path in (*shared_paths, frame_path, posixpath.join(out_dir, LABELLED)):
        paths.remove(spark, path)
    return written


def run_target(inputs: Inputs, config: TargetConfig, out_dir: str) -> dict[str, str]:
    return run_targets(inputs, out_dir, (config,))[config.name]


def tokenize_json(
    spark: SparkSession, path: str, keep: tuple[str, ...] = (), quarantine_path: str | None = None
) -> DataFrame:
    """Line-delimited JSON bodies to token arrays, as one distributed job.

    A line that is no JSON object is an error, or set apart at the ``quarantine_path``.
    """
    wanted = [f for f in schemas.COMMENTS if f.name in (*keep, "body")]
    lines = readers.read_json(spark, path, type(schemas.COMMENTS)(wanted), quarantine_path)
    return lines.select(*keep, text.sanitize(F.col("body")).alias("tokens"))
