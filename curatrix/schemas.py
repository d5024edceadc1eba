"""Schemas of the archive's tables, closed vocabularies and settings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

# The closed vocabularies of labels, and settings of the archive.
GATE_CATEGORIES = ("astronomical_observation", "hardware_engineering", "people_event", "artwork_illustration", "promotional_other")
KEEP_GATE = "astronomical_observation"
SUBJECTS = ("galaxy", "galaxy_cluster", "deep_field", "nebula", "planetary_nebula", "supernova_remnant", "star", "star_cluster", "protoplanetary_disk", "exoplanet", "solar_system", "black_hole", "other_astronomical", "not_applicable")
MODALITIES = ("image", "annotated_image", "spectrum_or_plot", "comparison_composite", "not_applicable")
INSTRUMENTS = ("NIRCam", "MIRI", "NIRSpec", "NIRISS", "FGS", "multiple", "non-Webb", "unknown")
CONFIDENCES = ("high", "medium", "low")
NOT_APPLICABLE = "not_applicable"
CODEBOOK_VERSION = "v6"
MODALITY_RANK = {"image": 0, "annotated_image": 1, "comparison_composite": 2, "spectrum_or_plot": 3}
LAUNCH_DATE = datetime(2021, 12, 25)
MAX_DOWNLOAD_ATTEMPTS = 3
EMBEDDING_DIM = 2048
BATCH_SIZE = 32
NEAR_DUPLICATE = 0.95
CAPTION_CHARS = 4000
ERROR_CHARS = 500
PAGE_SIZE = 500

#: Label fields with a closed vocabulary, in the order in which problems are told.
ENUMS = {"gate_category": GATE_CATEGORIES, "subject": SUBJECTS, "modality": MODALITIES, "instrument": INSTRUMENTS, "confidence": CONFIDENCES}


def _struct(required: str, **kinds) -> StructType:
    return StructType([StructField(name, kind, name not in required.split()) for name, kind in kinds.items()])


_S, _T, _I, _L, _B, _D = StringType(), TimestampNTZType(), IntegerType(), LongType(), BooleanType(), DoubleType()

PHOTOS = _struct(
    "photo_id first_seen_at download_attempts",
    photo_id=_S, title=_S, description=_S, tags=ArrayType(_S), date_taken=_T, first_seen_at=_T, last_seen_at=_T, image_file=_S,
    image_bytes=_L, downloaded_at=_T, download_attempts=_I, last_download_error=_S, legacy_tag_label=_S,
)
EMBEDDINGS = _struct("photo_id model vector created_at", photo_id=_S, model=_S, vector=ArrayType(FloatType(), False), created_at=_T)
EMBEDDING_ERRORS = _struct("photo_id error failed_at", photo_id=_S, error=_S, failed_at=_T)
LABELS = _struct(
    "photo_id gate_category subject modality instrument confidence model codebook_version",
    photo_id=_S, gate_category=_S, subject=_S, modality=_S, object_name=_S, instrument=_S, confidence=_S, rationale=_S, model=_S, backend=_S,
    vision=_B, codebook_version=_S, seconds=_D, prompt_tokens=_I, output_tokens=_I, cache_read_tokens=_I,
)
LOG_RECORD = StructType([StructField(f.name, f.dataType, True) for f in [*LABELS.fields, StructField("title", _S)]])
MIGRATIONS = _struct("version name applied_at", version=_I, name=_S, applied_at=_T)
TABLES = {"photos": PHOTOS, "embeddings": EMBEDDINGS, "embedding_errors": EMBEDDING_ERRORS, "labels": LABELS}

# The columns of the published tables.
KEPT_COLUMNS = (
    "photo_id", "title", "description", "subject", "modality", "object_name", "object_name_normalized", "object_name_verified", "instrument", "confidence",
    "rationale", "release_group", "near_duplicate_group", "is_primary", "tags", "date_taken", "page_url", "source_tag_label", "image_file", "has_embedding",
    "model", "codebook_version", "labelled_with_vision",
)
REJECTED_COLUMNS = ("photo_id", "title", "rejected_as", "rejected_by", "rationale", "date_taken", "page_url", "source_tag_label")
