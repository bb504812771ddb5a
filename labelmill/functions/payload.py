"""What a value in a published table is: a path, media bytes, a local path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions of payload files.
PAYLOAD_EXTENSIONS = (
    "fbd xml json png jpg jpeg gif webp glb usda usdc usdz npy npz ply obj stl wav mp3 "
    "flac mkv mov mp4 lot svg parquet safetensors gguf onnx"
).split()

# Leading bytes of media files, first match wins.
MEDIA_MAGIC = (
    ("PNG", "89504E470D0A1A0A"),
    ("JPEG", "FFD8FF"),
    ("GIF", "47494638"),
    ("RIFF", "52494646"),
    ("Matroska", "1A45DFA3"),
    ("OggS", "4F676753"),
    ("glTF", "676C5446"),
)
MEDIA_DTYPES = ("image", "audio", "video")

# What names a local filesystem. A drive letter counts only where
# no word character stands before it. The pattern has no look-behind, so the
# same text works in RE2.
LOCAL_PATH = r"(?i)(?:^|[^A-Za-z0-9_])[a-z]:[\\/]|/mnt/[a-z]/|/users/|/home/"
FORBIDDEN_MARKERS = ("c:/users", "c:\\users", "/home/", "/private/tmp")
TEXT_SUFFIXES = (".json", ".md", ".txt", ".cff")

WHITESPACE = " \t\n\r\u000b\u000c"


def payload_path(value: Column) -> Column:
    """A single token with a known payload extension. A bare extension is not a path."""
    trimmed = F.btrim(value, F.lit(WHITESPACE))
    extension = F.lower(F.substring_index(trimmed, ".", -1))
    one_token = (trimmed != "") & ~trimmed.rlike("[\n ]")
    return F.coalesce(one_token & F.contains(trimmed, F.lit(".")) & extension.isin(PAYLOAD_EXTENSIONS), F.lit(False))


def dataset_path(value: Column) -> Column:
    """A path as the dataset lists it: leading dots and slashes of ``./`` removed."""
    return F.regexp_replace(value, r"^(?:\./)+", "")


def media_magic(content: Column) -> Column:
    """The media kind the bytes start with, or null."""
    kind = None
    for name, prefix in MEDIA_MAGIC:
        starts = F.startswith(content, F.unhex(F.lit(prefix)))
        kind = F.when(starts, F.lit(name)) if kind is None else kind.when(starts, F.lit(name))
    return kind


def media_dtype(dtype: Column) -> Column:
    return F.coalesce(dtype.isin(*MEDIA_DTYPES), F.lit(False))


def names_local_path(text: Column) -> Column:
    return F.coalesce(text.rlike(LOCAL_PATH), F.lit(False))


def forbidden_marker(path: Column) -> Column:
    markers = F.array(*[F.lit(m) for m in FORBIDDEN_MARKERS])
    return F.exists(markers, lambda m: F.contains(F.lower(path), m))


def suffix(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.when(name.rlike(r"[^.]\.[^.]*$"), F.concat(F.lit("."), F.lower(F.substring_index(name, ".", -1)))).otherwise("")


def publishable_text(path: Column) -> Column:
    """Staged text that is uploaded: four suffixes, outside the scratch tree."""
    return suffix(path).isin(*TEXT_SUFFIXES) & (F.substring_index(path, "/", 1) != "rows")


def uploaded(path: Column) -> Column:
    return ~(F.startswith(path, F.lit("rows/")) | F.endswith(path, F.lit(".bak")))


def wrong_magic(kind: Column, content: Column) -> Column:
    """Why the bytes do not fit the entry's kind, or null."""
    wav = F.startswith(content, F.unhex(F.lit("52494646")))
    png = F.startswith(content, F.unhex(F.lit("89504E470D0A1A0A")))
    return F.when((kind == "utterance") & ~wav, F.lit("not_a_wav")).when(
        (kind != "utterance") & ~png, F.lit("not_a_png")
    )
