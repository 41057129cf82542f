"""Text column functions.

Only the NFKD fold needs Python: Spark SQL has no Unicode normalisation
built-in. It runs as an Arrow-batched UDF whose body is two vectorised
pyarrow kernels (no per-row Python); everything else stays JVM-side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's UDF bodies by value: Python workers then need only
# pyarrow, not this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: everything outside 7-bit ASCII is dropped after NFKD.
NON_ASCII_PATTERN = r"[^\x00-\x7F]"
# Fixed value: a URL's query string starts at the first "?".
URL_QUERY_PATTERN = r"\?.*"


# Fixed value: the kernels' working copies are those of a piece this long (or of one text).
PIECE_BYTES = 1 << 20


def _pieces(text: pa.Array) -> Iterator[pa.Array]:
    """The batch in slices of at most ``PIECE_BYTES`` of text, or of one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(text):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield text.slice(at, stop - at)
        at = stop


def _fold(text: pa.Array) -> pa.Array:
    decomposed = pc.utf8_normalize(text, form="NFKD")
    return pc.replace_substring_regex(decomposed, pattern=NON_ASCII_PATTERN, replacement="")


@F.arrow_udf(T.StringType())
def strip_accents(text: pa.Array) -> pa.Array:
    """NFKD-decompose, then drop every non-ASCII code point (NULL stays NULL). [O-49]

    Accents fold to their base letter, compatibility forms expand
    (``½`` -> ``12``, ``ﬁ`` -> ``fi``) and emoji vanish.
    """
    if len(text) == 0:
        return text
    whole = pa.concat_arrays([_fold(piece) for piece in _pieces(text)])
    # what the allocator keeps of the pieces and of earlier batches goes back to the system
    pa.default_memory_pool().release_unused()
    return whole


def normalise_text(col: Column | str) -> Column:
    """Accent/emoji strip followed by upper-casing (idempotent). [O-24, O-49]"""
    return F.upper(strip_accents(col))


# Fixed value: XML escapes for element text and quoted attributes; "&" comes
# first so the entities added after it are not escaped again.
XML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;"))


def xml_escape(col: Column | str) -> Column:
    """Escape a string for XML element text or a quoted attribute (JVM-side)."""
    c = F.col(col) if isinstance(col, str) else col
    for raw, entity in XML_ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def xml_escape_sql(expr: str) -> str:
    """The same escape as SQL text around the SQL expression ``expr``."""
    for raw, entity in XML_ESCAPES:
        raw_sql = "\\r" if raw == "\r" else raw.replace("'", "\\'")
        expr = f"replace({expr}, '{raw_sql}', '{entity}')"
    return expr


def url_strip_query(col: Column | str) -> Column:
    """Remove the query string (from the first ``?``) of a URL. [O-27]"""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, URL_QUERY_PATTERN, "")
