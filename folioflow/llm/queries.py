"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import licenses, quality
from .bpe import op3_bpe
from .html import op5_html
from .langid import op4_langid
from .licenses import op6_licenses
from .mixing import op10_mixing
from .pii import op7_pii
from .quality import op2_quality
from .repeats import op9_repeats
from .simhash import op8_simhash
from .vectors import op1_vectors

QUERIES = {
    "op1_vectors": op1_vectors,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_langid": op4_langid,
    "op5_html": op5_html,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_simhash": op8_simhash,
    "op9_repeats": op9_repeats,
    "op10_mixing": op10_mixing,
}
ORACLE_SQL: dict[str, str] = {"op2_quality": quality.oracle(), "op6_licenses": licenses.oracle()}
