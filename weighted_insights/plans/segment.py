"""The segmentation job: read, clean, prepare, cluster, profile, persist."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import survey
from ..functions.cleaning import clean, label_and_weight, present, quoted
from ..functions.features import add_bands
from ..operators.prep import FeatureSpec, fit_prep, segment_spec
from ..operators.profiles import crosstab, numeric_means, segment_shares, segment_summary, top_per_segment
from ..sources import writer
from ..sources.reader import read_column_names, read_survey, with_row_id
from ..storage import scratch, settle
from . import clustering as C


@dataclass(frozen=True)
class Segments:
    """What the segmentation job found; the tables are lazy."""

    assigned: DataFrame
    summary: DataFrame
    shares: DataFrame
    crosstabs: DataFrame
    means: DataFrame
    top: DataFrame
    elbow: DataFrame | None
    k: int
    suggested_k: int | None
    n_features: int
    model: PipelineModel


def cluster_and_profile(
    rows: DataFrame,
    spec: FeatureSpec,
    label: str = "y",
    weight: str = "w",
    means: Sequence[str] = (),
    crosstabs: Sequence[str] = (),
    tops: Sequence[str] = (),
    top_n: int = 6,
    k: int = 0,
    k_min: int = C.K_MIN,
    k_max: int = C.K_MAX,
    restarts: int = C.RESTARTS,
    seed: int = C.SEED,
    row_id: str = "row_id",
) -> Segments:
    """Cluster the prepared rows and profile the clusters.  ``rows`` is read several times.

    Draws tell rows apart by ``row_id``; without such a column equal rows are drawn as one.
    """
    prep = fit_prep(rows, spec)
    pipeline = prep.pipeline(rows)
    vectors = pipeline.transform(rows)
    # The fits' own tables are needed no longer than the fits.
    with scratch():
        found = C.segment(vectors, k, k_min, k_max, weight=weight, restarts=restarts, seed=seed, row_id=row_id if row_id in rows.columns else None)
    model = PipelineModel([*pipeline.stages, found.model])
    kept = [quoted(c) for c in rows.columns]
    assigned = settle(model.transform(rows).select(*kept, F.col("cluster").alias("segment")), "assigned")
    profiled = add_bands(assigned)
    return Segments(
        assigned=assigned,
        summary=segment_summary(assigned, "segment", weight, label, present(assigned, means)),
        shares=segment_shares(assigned, "segment", weight),
        crosstabs=crosstab(profiled, present(profiled, crosstabs), top_n, "segment", weight),
        means=numeric_means(assigned, present(assigned, means), "segment", weight),
        top=top_per_segment(profiled, present(profiled, tops), 3, "segment", weight),
        elbow=found.elbow,
        k=found.k,
        suggested_k=found.suggested_k,
        n_features=prep.n_features,
        model=model,
    )


def run(
    spark: SparkSession,
    data_path: str,
    columns_path: str | None = None,
    outputs: str = "outputs",
    models_dir: str | None = None,
    segments_out: str = "",
    summary_out: str = "",
    run_name: str = "",
    k: int = 0,
    k_min: int = C.K_MIN,
    k_max: int = C.K_MAX,
    restarts: int = C.RESTARTS,
    profile_topn: int = 6,
    seed: int = 42,
) -> Segments:
    """The whole job on a survey file.  The model is saved where ``models_dir`` is given."""
    arguments = {name: v for name, v in locals().items() if name != "spark"}
    run_id = writer.run_id(run_name)
    folder = writer.run_folder(outputs, run_id)
    segments_path, summary_path = segments_out or f"{folder}/segments", summary_out or f"{folder}/summary"
    arguments |= {"run_dir": folder, "segments_out": segments_path, "summary_out": summary_path}
    writer.write_manifest(spark, f"{folder}/run", run_id, arguments)

    names = read_column_names(spark, columns_path) if columns_path else None
    raw = with_row_id(read_survey(spark, data_path, names))
    rows = settle(label_and_weight(clean(raw)), "segment-rows")
    result = cluster_and_profile(
        rows,
        segment_spec(rows),
        means=survey.PROFILE_MEANS,
        crosstabs=survey.PROFILE_CROSSTABS,
        tops=survey.PROFILE_TOP_CATEGORIES,
        top_n=profile_topn,
        k=k,
        k_min=k_min,
        k_max=k_max,
        restarts=restarts,
        seed=seed,
    )
    writer.write_assignments(
        result.assigned, segments_path, "row_id", "segment", result.k
    )
    named = result.summary.withColumnRenamed("segment", "cluster")
    writer.write_summary(named, summary_path)
    result.shares.write.mode("overwrite").parquet(f"{folder}/profile/shares")
    result.crosstabs.write.mode("overwrite").parquet(f"{folder}/profile/crosstabs")
    result.means.write.mode("overwrite").parquet(f"{folder}/profile/means")
    result.top.write.mode("overwrite").parquet(f"{folder}/profile/top_categories")
    if result.elbow is not None:
        result.elbow.write.mode("overwrite").parquet(f"{folder}/profile/elbow")
    if models_dir:
        name = f"seg_kmeans_k{result.k}"
        result.model.write().overwrite().save(f"{models_dir.rstrip('/')}/{name}")
    return result
