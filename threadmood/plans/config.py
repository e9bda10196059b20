"""One configuration per label target."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TargetConfig:
    """What differs between targets; paths are relative to the output folder."""

    name: str
    label_col: str
    folds: int
    sample_fraction: float
    model_dir: str
    scored_path: str
    reports: dict[str, str] = field(default_factory=dict)
    seed: int = 42
    # sample rows independently instead of by comment id
    bernoulli: bool = False
    # each report as one file, written by one task; else several files in key order
    single_file: bool = True


# fixed values: label columns, folds, fractions and paths of the three targets
DEM = TargetConfig(
    name="dem",
    label_col="labeldem",
    folds=5,
    sample_fraction=0.05,
    model_dir="dem",
    scored_path="dem/final.parquet",
    reports={
        "overall": "EC/question1Dem.csv",
        "by_day": "EC/question2Dem.csv",
        "by_place": "EC/question3Dem.csv",
    },
)
GOP = TargetConfig(
    name="gop",
    label_col="labelgop",
    folds=5,
    sample_fraction=0.05,
    model_dir="gop",
    scored_path="gop/final.parquet",
    reports={
        "overall": "EC/question1Gop.csv",
        "by_day": "EC/question2Gop.csv",
        "by_place": "EC/question3Gop.csv",
    },
)
DJT = TargetConfig(
    name="djt",
    label_col="labeldjt",
    folds=2,
    sample_fraction=0.1,
    model_dir="www",
    scored_path="final.parquet",
    reports={
        "overall": "question1.csv",
        "by_day": "question2.csv",
        "by_place": "question3.csv",
        "by_comment_score": "question4_comment.csv",
        "by_story_score": "question4_story.csv",
    },
)
TARGETS = {t.name: t for t in (DEM, GOP, DJT)}

# fixed value, shared by all targets
VECTORIZER_PATH = "cvModel"
