"""Publication gates: block reasons of sources and evidence, expiries, the public projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Reasons, in the order in which they are reported.
REASONS = (
    "SOURCE_NOT_APPROVED", "SOURCE_APPROVAL_EXPIRY_MISSING", "SOURCE_APPROVAL_EXPIRED", "PURPOSE_NOT_COMPATIBLE", "REUSE_NOT_APPROVED", "EVIDENCE_NOT_APPROVED", "CONFIDENCE_NOT_PUBLISHABLE",
    "EVIDENCE_EXPIRED",
)


def block_reasons(source_state: Column, source_until: Column, purpose: Column, reuse: Column, state: Column, confidence: Column, until: Column, as_of: Column) -> Column:
    """Every reason against publishing, in order; a deadline is over at its own instant."""
    missing = (source_state == "APPROVED") & source_until.isNull()
    tests = (source_state != "APPROVED", missing, source_until <= as_of, purpose != "COMPATIBLE", reuse == "PENDING", state != "APPROVED", confidence == "CANDIDATE", until <= as_of)
    return F.filter(F.array(*[F.when(t, F.lit(r)) for t, r in zip(tests, REASONS)]), lambda x: x.isNotNull())


def earliest_expiry(*dates: Column) -> Column:
    return F.least(*dates)


def leaf_paths(schema: StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves of a nested schema; [] marks arrays."""
    out: list[str] = []
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        while isinstance(kind, ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += leaf_paths(kind, path + ".") if isinstance(kind, StructType) else [path]
    return out


def project_allowed(df: DataFrame, allowed: list[str]) -> DataFrame:
    """The allowed columns; fails while planning if the leaves differ from the list."""
    out = df.select(*dict.fromkeys(p.split(".")[0].removesuffix("[]") for p in allowed))
    if sorted(leaf_paths(out.schema)) != sorted(allowed):
        raise ValueError(f"fields differ from the allowlist: {sorted(set(leaf_paths(out.schema)) ^ set(allowed))}")
    return out


def expired(df: DataFrame, as_of: Column, *expiries: str) -> DataFrame:
    return df.where(F.least(*[F.col(c) for c in expiries]) <= as_of)
