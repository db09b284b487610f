"""Record and listing schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_LINKS = T.ArrayType(T.StringType())


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


# One record of a snapshot as it is stored: an id and an object whose keys may be absent.
STORED_RECORD = "id string, fields variant"

LISTING = _fields(
    ("mod", T.TimestampType()),
    ("size", T.LongType()),
    ("path", T.StringType()),
    ("dir", T.StringType()),
    ("file", T.StringType()),
    ("seqprep", T.StringType()),
    ("s_well", T.StringType()),
    ("suffix", T.StringType()),
)

# Typed views of the record tables whose fields are known; other fields stay in ``fields``.
RECORD_FIELDS = {
    "Projects": _fields(("uid", T.StringType()), ("name", T.StringType()), ("Visits", _LINKS), ("Subjects", _LINKS)),
    "Subjects": _fields(
        ("uid", T.StringType()),
        ("subject_id", T.StringType()),
        ("Biospecimens", _LINKS),
        ("project", _LINKS),
        ("keep", T.IntegerType()),
    ),
    "Biospecimens": _fields(
        ("uid", T.StringType()),
        ("subject", _LINKS),
        ("collection", T.IntegerType()),
        ("collection_buffer", _LINKS),
        ("visit", _LINKS),
        ("aliases", _LINKS),
        ("project", _LINKS),
        ("seqprep", _LINKS),
        ("keep", T.IntegerType()),
    ),
    "SequencingPrep": _fields(
        ("uid", T.StringType()),
        ("biospecimen", _LINKS),
        ("S_well", T.StringType()),
        ("sequencing_batch", T.StringType()),
        ("kneaddata", T.BooleanType()),
        ("metaphlan", T.BooleanType()),
        ("humann", T.BooleanType()),
        ("keep", T.IntegerType()),
    ),
    "Visits": _fields(("uid", T.StringType()), ("Biospecimens", _LINKS)),
}
