"""Column-level helpers built only from Spark built-in functions.

Everything here returns a ``Column`` so it stays inside whole-stage codegen
(or the interpreted higher-order-function path) on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spindle import constants as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pretokenize(text) -> Column:
    """Lossless pre-tokens; ``concat`` of the result equals the input."""
    return F.regexp_extract_all(_c(text), F.lit(C.PRETOKEN_PATTERN), 0)


def normalize_newlines(text) -> Column:
    """Universal-newline translation used when reading text files."""
    return F.regexp_replace(_c(text), "\r\n?", "\n")


def split_lines(text) -> Column:
    """Lines with their newline kept; the empty tail is never produced."""
    return F.regexp_extract_all(normalize_newlines(text), F.lit(C.LINE_PATTERN), 0)


def utf8_hex(text) -> Column:
    """Upper-case hex of the UTF-8 bytes of a string."""
    return F.hex(F.encode(_c(text), "UTF-8"))


def utf8_byte_ids(text) -> Column:
    """Byte-fallback ids: the UTF-8 bytes of a string as ints 0..255."""
    return F.transform(
        F.regexp_extract_all(utf8_hex(text), F.lit(".."), 0),
        lambda h: F.conv(h, 16, 10).cast("int"),
    )


def strip_left(text) -> Column:
    """Python ``str.lstrip()`` for the whitespace a token can start with."""
    return F.regexp_replace(_c(text), r"^\s+", "")


def md5_uniform(seed, seq_id, step) -> Column:
    """A uniform double in [0, 1) from (seed, seq_id, step).

    52 bits of an md5 digest; reproducible in any engine with md5, unlike rand().
    """
    key = F.concat_ws("|", _c(seed).cast("string"), _c(seq_id).cast("string"),
                      _c(step).cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
            / F.lit(float(2 ** 52)))


def dataset_tag(choice) -> Column:
    """Tag of a dataset choice.

    The three named datasets have fixed tags; anything else is treated as a
    path: base name, extension removed like ``os.path.splitext``, cut to 32.
    """
    c = _c(choice)
    base = F.element_at(F.split(c, "/", -1), -1)
    stem = F.regexp_replace(base, r"^(\.*[^.].*)\.[^.]*$", "$1")
    tag = F.substring(stem, 1, C.TAG_LENGTH)
    for name, fixed in C.NAMED_DATASETS.items():
        tag = F.when(c == F.lit(name), F.lit(fixed)).otherwise(tag)
    return tag


def ids_to_string(ids) -> Column:
    """Render an id array as space-separated text (for tables and oracles)."""
    return F.array_join(F.transform(_c(ids), lambda i: i.cast("string")), " ")
