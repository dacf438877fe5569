"""Message templates from text files."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from rosterkeep.operators.notify import Template

#: Subjects when none are given.
SUBJECTS = {
    "delete": "Your account has been deleted",
    "flag": "Action needed: your account has been flagged for deletion",
    "quota": "Action needed: storage quota exceeded",
}

#: Bodies when no files are given.
BODIES = {
    "delete": "Dear {recipient_name},\n\nyour account {recipient_username} will be deleted.\n",
    "flag": "Dear {recipient_name},\n\nyour account {recipient_username} is flagged and will be deleted in a month.\n",
    "quota": (
        "Dear {recipient_name},\n\nyour account {recipient_username} uses {total_feature_storage_mb} MB; "
        "the quota is {USER_STORAGE_QUOTA_MB} MB.\n"
    ),
}

DEFAULT_TEMPLATES = {kind: Template(SUBJECTS[kind], BODIES[kind]) for kind in SUBJECTS}


def read_templates(spark: SparkSession, folder: str, subjects: dict[str, str] = SUBJECTS) -> dict[str, Template]:
    """Templates ``<kind>.txt`` of a folder, one file per kind and no other file; they are part of the configuration."""
    found = {}
    for kind, subject in subjects.items():
        texts = spark.read.text(f"{folder}/{kind}.txt", wholetext=True).select(F.col("value")).head(1)
        found[kind] = Template(subject, texts[0]["value"] if texts else "")
    return found
