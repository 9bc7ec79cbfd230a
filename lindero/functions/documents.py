"""Single documents on the driver: canonical JSON, keyed tags, publication policies, settings."""

from __future__ import annotations

import hashlib
import hmac
import json
import math
import re
from datetime import datetime, timezone

# The tag's context, key ids, shapes of a policy.
CONTEXT = b"medicos-public-directory-artifact:v1\x00"
KEY_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._:-]{2,127}")
TOP = ("approvedSnapshot", "policyExpiresAt", "policyId", "releasePrerequisites", "schemaVersion", "source")
SOURCE = (
    "allowedFieldPaths", "attribution", "canonicalUrl", "dataset", "key", "legalBasis", "liveLookupUrl", "maxSourceAgeDays", "publisher", "purposeCompatibility", "reuseAuthorization", "validUntil",
)
PREREQUISITES = ("controllerNotice", "databaseRegistration", "impactAssessmentAndDpoDetermination", "rightsRequestWorkflow", "securityAndRetentionControls")
DECISION = ("approved", "reference", "reviewedAt", "reviewedBy")
BASES = ("OPEN_DATA_LICENSE", "WRITTEN_AUTHORIZATION", "OFFICIAL_PUBLICATION_REVIEW")
ALLOWED = (
    "schemaVersion", "id", "slug", "displayName", "registeredTitles.title", "registeredTitles.temporaryRegistration", "source.publisher", "source.dataset", "source.canonicalUrl", "source.liveLookupUrl", "source.sourceCutoffDate", "source.validUntil",
    "source.attribution", "source.reuseBasis", "source.policyId", "notice.notMedicalAdvice", "notice.notRealTime", "notice.verifyWithOfficialSource",
)


def canonical_json(value: object) -> str:
    """One spelling of a document: keys in order of UTF-16 code units, no spaces, nothing escaped that needn't be."""
    if value is None or isinstance(value, str | bool | int):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, float) and math.isfinite(value):
        return json.dumps(int(value) if value.is_integer() and abs(value) < 1e21 else value)
    if isinstance(value, list | tuple):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical_json(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be"))) + "}"
    raise ValueError(f"no JSON value: {value!r}")


def tag(document: object, key: bytes) -> str:
    """HMAC-SHA256 of a document's canonical form."""
    if len(key) < 32:
        raise ValueError("a key needs 32 bytes or more")
    return hmac.new(key, CONTEXT + canonical_json(document).encode(), hashlib.sha256).hexdigest()


def sealed(body: dict, key: bytes, key_id: str) -> dict:
    """The document with its authentication: the tag covers all but itself."""
    if not KEY_ID.fullmatch(key_id):
        raise ValueError("invalid key id")
    document = body | {"authentication": {"algorithm": "HMAC-SHA256", "keyId": key_id}}
    return document | {"authentication": document["authentication"] | {"tag": tag(document, key)}}


def is_sealed(document: dict, key: bytes, key_id: str) -> bool:
    """Whether the tag is the document's, compared in constant time."""
    head = document.get("authentication")
    if not isinstance(head, dict) or set(head) != {"algorithm", "keyId", "tag"} or head["algorithm"] != "HMAC-SHA256" or head["keyId"] != key_id:
        return False
    bare = document | {"authentication": {k: v for k, v in head.items() if k != "tag"}}
    return hmac.compare_digest(tag(bare, key), str(head["tag"]))


def instant(value: object) -> datetime:
    """A canonical UTC instant with milliseconds."""
    if not isinstance(value, str) or not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z", value):
        raise ValueError(f"no canonical instant: {value!r}")
    return datetime.strptime(value, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc)


def _keys(value: object, keys: tuple[str, ...], what: str) -> dict:
    if not isinstance(value, dict) or set(value) != set(keys):
        raise ValueError(f"{what}: fields differ")
    return value


def _text(holder: dict, key: str) -> str:
    if not isinstance(holder[key], str) or not holder[key].strip():
        raise ValueError(f"{key}: text is needed")
    return holder[key].strip()


def _decision(value: object, what: str, now: datetime, more: tuple[str, ...] = ()) -> None:
    d = _keys(value, (*DECISION, *more), what)
    if d["approved"] is not True:
        raise ValueError(f"{what}: not approved")
    if instant(d["reviewedAt"]) > now:
        raise ValueError(f"{what}: reviewed in the future")
    _text(d, "reviewedBy"), _text(d, "reference")


def parse_policy(data: bytes, source_key: str, now: datetime) -> dict:
    """A publication policy, if it is whole, approved in every point, not expired, and written canonically (indented by two,
    one line end); ValueError otherwise."""
    policy = json.loads(data)
    _keys(policy, TOP, "policy")
    if data != (json.dumps(policy, ensure_ascii=False, indent=2) + "\n").encode():
        raise ValueError("policy: not in canonical form")
    if policy["schemaVersion"] != 1 or isinstance(policy["schemaVersion"], bool):
        raise ValueError("policy: schemaVersion")
    if instant(policy["policyExpiresAt"]) <= now:
        raise ValueError("policy: expired")
    _text(policy, "policyId")
    source = _keys(policy["source"], SOURCE, "source")
    if source["key"] != source_key or instant(source["validUntil"]) <= now:
        raise ValueError("source: another one, or expired")
    for k in ("publisher", "dataset", "attribution"):
        _text(source, k)
    for k in ("canonicalUrl", "liveLookupUrl"):
        if not re.match(r"https://[^\s/]+", _text(source, k)):
            raise ValueError(f"{k}: https is needed")
    days = source["maxSourceAgeDays"]
    if not isinstance(days, int) or isinstance(days, bool) or not 1 <= days <= 366:
        raise ValueError("maxSourceAgeDays: 1 to 366")
    if sorted(set(source["allowedFieldPaths"])) != sorted(ALLOWED):
        raise ValueError("allowedFieldPaths differ")
    snapshot = _keys(policy["approvedSnapshot"], ("profilesSha256", "snapshotId"), "snapshot")
    if not re.fullmatch("factual-v3-[0-9a-f]{16}", _text(snapshot, "snapshotId")) or not re.fullmatch("[0-9a-f]{64}", _text(snapshot, "profilesSha256")):
        raise ValueError("snapshot: invalid")
    _decision(source["legalBasis"], "legalBasis", now)
    _decision(source["purposeCompatibility"], "purposeCompatibility", now)
    _decision(source["reuseAuthorization"], "reuseAuthorization", now, ("basis",))
    if source["reuseAuthorization"]["basis"] not in BASES:
        raise ValueError("reuse basis: not approved")
    for k, v in _keys(policy["releasePrerequisites"], PREREQUISITES, "prerequisites").items():
        _decision(v, k, now)
    return policy


def flag(value: str | None, default: bool = False) -> bool:
    """A setting that is true or false; blank or absent: the default."""
    text = (value or "").strip().lower()
    if text in ("true", "1", "yes"):
        return True
    if text in ("false", "0", "no"):
        return False
    if text:
        raise ValueError(f"neither true nor false: {value!r}")
    return default


def bounded(value: str | None, default: int, least: int, most: int) -> int:
    """A whole number within bounds; blank or absent: the default."""
    text = (value or "").strip()
    if not text:
        return default
    if not re.fullmatch(r"-?\d{1,15}", text) or not least <= int(text) <= most:
        raise ValueError(f"a whole number from {least} to {most} is needed: {value!r}")
    return int(text)
