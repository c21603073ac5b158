"""Options of detection, curation and evaluation, and the two built-in detection profiles."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path

from . import keyword_lists

# Patterns, keywords and scores decide the results, so they stand here as they must be.
SSN_DASH, SSN_SPACE, SSN_DOT, NINE = r"\b\d{3}-\d{2}-\d{4}\b", r"\b\d{3} \d{2} \d{4}\b", r"\b\d{3}\.\d{2}\.\d{4}\b", r"\b\d{9}\b"
DATES = (r"\b\d{4}-\d{2}-\d{2}\b", r"\b\d{1,2}/\d{1,2}/\d{4}\b", r"\b[A-Z][a-z]{2,8} \d{1,2},? \d{4}\b")
STREET = (
    r"\b\d{1,5}\s+[A-Za-z0-9 .]+\s+(?:St|Street|Rd|Road|Ave|Avenue|Blvd|Lane|Ln|Drive|Dr|Way|Court|Ct|Place|Pl|Circle|Cir)\b"
    r"(?:.{0,20}(?:Apt|Unit|#|Suite|Ste|Floor|Fl)\s*\w+)?(?:.{0,30}(?:\d{5}(?:-\d{4})?)?)?"
)
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_INTERNATIONAL = r"\+\d{1,4}[-. ]?\d{2,4}[-. ]?\d{3,4}[-. ]?\d{3,4}(?:[-. ]?\d{1,4})?"
PHONE_THREE_GROUPS = r"\+?\d{1,4}[-. ]\d{4,6}[-. ]\d{4}"
PATTERNS = {
    "constants": {
        "SSN": (SSN_DASH, SSN_SPACE, SSN_DOT, NINE),
        "PHONE_NUMBER": (
            r"(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}(?:[-. ]?\d{1,5})?",
            PHONE_INTERNATIONAL,
            PHONE_THREE_GROUPS,
            r"\b\d{4,6}[-. ]\d{5,6}\b",
        ),
        "DATE": DATES,
        "ACCOUNT_NUMBER": (r"\b\d{10,17}\b", r"\b[A-Z]{2}\d{10,}\b"),
        "ADDRESS": (STREET, r"\b\d{5}(?:-\d{4})?\b", r"\b\d{4}\b"),
        "EMAIL": (EMAIL,),
    },
    "config": {
        "SSN": (SSN_DASH, SSN_SPACE, NINE),
        "PHONE_NUMBER": (
            r"(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}(?:[-. ]?\d{1,5})?",
            PHONE_INTERNATIONAL,
            PHONE_THREE_GROUPS,
        ),
        "DATE": DATES,
        "ACCOUNT_NUMBER": (r"\b\d{8,17}\b", r"\b[A-Z0-9]{2,}\d{6,}\b"),
        "ADDRESS": (STREET,),
        "EMAIL": (EMAIL,),
    },
}
BIRTH_WORDS = ("dob", "date of birth", "born", "birthdate", "birth")
ADDRESS_WORDS = ("address", "addr", "ship to", "billing", "street", "residence", "live at", "located at")
ZIP_WORDS = ("zip", "zip code", "zipcode", "postal", "postcode")
KEYWORDS = {
    "constants": {
        "SSN": ("ssn", "social security", "soc sec"),
        "PHONE_NUMBER": ("phone", "tel", "mobile", "cell", "fax", "contact"),
        "BIRTHDATE": BIRTH_WORDS,
        "ACCOUNT_NUMBER": ("account", "acct", "a/c", "iban", "routing", "swift", "bank"),
        "ADDRESS": ADDRESS_WORDS + ZIP_WORDS,
    },
    "config": {
        "SSN": ("ssn", "social security", "soc sec"),
        "PHONE_NUMBER": ("phone", "tel", "mobile", "cell", "fax", "contact"),
        "BIRTHDATE": BIRTH_WORDS,
        "ACCOUNT_NUMBER": ("account", "acct", "a/c", "iban", "routing", "swift", "bank"),
        "ADDRESS": ADDRESS_WORDS,
        "PERSON": (
            "name", "mr", "mrs", "ms", "miss", "dr", "patient", "client", "customer", "employee", "applicant",
            "full name", "first name", "last name", "surname", "signed by",
        ),
    },
}
NEGATIVE_WORDS = {
    "PHONE_NUMBER": (
        "id", "id:", "id card", "identification", "passport", "imei", "driver", "license", "account", "acct", "cc",
        "credit card", "card:", "card ending", "payment", "policy", "record", "verification", "tax", "iban", "masked",
        "inv-", "order-", "bill-", "trans-", "file", "reference", "ref", "ref-", "doc", "doc no", "docnum", "document",
        "form", "form id", "incident", "food item", "number:", "authenticated", "verified", "ids",
    ),
    "SSN": (
        "passport", "passport number", "driver", "license", "id card", "id number", "identification", "national id",
        "employee id", "student id", "member id", "tax", "tax number", "taxnum", "tax id", "tin",
    ),
    "ACCOUNT_NUMBER": (
        "credit card", "card:", "card number", "cc:", "debit card", "visa", "mastercard", "amex", "passport",
        "passport number", "phone", "tel", "mobile", "fax", "driver", "license", "id card", "id number", "ssn",
        "social security", "id", "id:", "ref", "ref-", "doc", "doc no", "docnum", "document", "form", "form id",
        "policy", "reference", "report id", "imei", "vin", "invoice", "payment", "transaction", "order",
    ),
}
RETYPE_ACCOUNT_WORDS = ("account", "acct", "a/c", "account number", "account no", "bank account", "checking", "savings", "deposit")
SCORES = {
    "PERSON": 0.80, "LOCATION": 0.75, "SSN": 0.95, "PHONE_NUMBER": 0.85, "DATE": 0.75, "BIRTHDATE": 0.75,
    "ACCOUNT_NUMBER": 0.80, "ADDRESS": 0.70, "EMAIL": 0.90, "CREDIT_CARD_NUMBER": 0.95, "DRIVERS_LICENSE": 0.90,
    "ID_CARD": 0.90, "TAX_NUMBER": 0.90, "USERNAME": 0.85, "PASSWORD": 0.95, "ZIPCODE": 0.75,
}
STREET_SUFFIXES = (
    "st", "street", "rd", "road", "ave", "avenue", "blvd", "lane", "ln", "drive", "dr", "way", "court", "ct", "place", "pl", "circle", "cir",
)
# Patterns of list files that a configuration may take in place of its own.
PHONE_LIST = (
    r"(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}",
    r"(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}(?:\s*(?:ext|x|ext\.)\s*\d{1,5})?",
    r"\+\d{1,4}[-. ]?\(?\d{1,4}\)?[-. ]?\d{1,4}[-. ]?\d{1,4}(?:[-. ]?\d{1,4})?",
    r"\+?44[-. ]?\d{2,4}[-. ]?\d{3,4}[-. ]?\d{3,4}",
    r"\+\d{1,4}[-. ]\d{4,6}[-. ]\d{4}",
    r"\b\d{10}\b",
    r"\b1?[-. ]?8(?:00|33|44|55|66|77|88)[-. ]?\d{3}[-. ]?\d{4}\b",
    r"\b1?[-. ]?8(?:00|33|44|55|66|77|88)[-. ]?[A-Z0-9]{3}[-. ]?[A-Z0-9]{4}\b",
    r"\+49[-. ]?\d{2,5}[-. ]?\d{5,10}",
    r"\+33[-. ]?\d[-. ]?\d{2}[-. ]?\d{2}[-. ]?\d{2}[-. ]?\d{2}",
    r"\+61[-. ]?\d[-. ]?\d{4}[-. ]?\d{4}",
    r"\(\d{2,4}\)[-. ]?\d{3,4}[-. ]?\d{3,4}",
)
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
SHORT_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
DATE_LIST = (
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\b\d{1,2}/\d{1,2}/\d{4}\b",
    r"\b\d{1,2}-\d{1,2}-\d{4}\b",
    r"\b\d{1,2}\.\d{1,2}\.\d{4}\b",
    r"\b\d{1,2}/\d{1,2}/\d{2}\b",
    r"\b\d{1,2}-\d{1,2}-\d{2}\b",
    r"\b\d{1,2}\.\d{1,2}\.\d{2}\b",
    rf"\b(?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"\b(?:{SHORT_MONTHS})\.?\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+(?:{MONTHS})\s+\d{{4}}\b",
    rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+(?:{SHORT_MONTHS})\.?\s+\d{{4}}\b",
    rf"\b(?:{MONTHS})\s+\d{{4}}\b",
    rf"\b(?:{SHORT_MONTHS})\.?\s+\d{{4}}\b",
    r"\b(?:19|20)\d{6}\b",
)
ENTITY_TYPES = tuple(SCORES)
DETECTORS = ("ner", "regex", "dict")
# End of the fixed values.


@dataclass(frozen=True)
class Scoring:
    min_score: float = 0.0
    context_boost: float = 0.10
    multi_model_boost: float = 0.10
    max_score: float = 0.99
    account_no_context_score: float = 0.60
    account_min_digits: int = 8


@dataclass(frozen=True)
class LuhnRetype:
    enabled: bool = True
    min_length: int = 13
    max_length: int = 19
    require_no_account_context: bool = True
    target_type: str = "CREDIT_CARD_NUMBER"


@dataclass(frozen=True)
class AddressFilter:
    """``require_suffix`` never matches in the known behaviour; ``whole_word_suffix`` makes it work."""

    enabled: bool = True
    sources: tuple[str, ...] = ("ner",)
    min_single_token_length: int = 4
    allow_single_token_digits: bool = True
    allowed_single_tokens: tuple[str, ...] = ()
    require_digit: bool = False
    require_suffix: bool = False
    suffixes: tuple[str, ...] = STREET_SUFFIXES
    whole_word_suffix: bool = False


@dataclass(frozen=True)
class GatewayTest:
    name: str
    enabled: bool = True
    threshold: int | None = None


@dataclass(frozen=True)
class NameLists:
    """Files of names and of words that are none: ``.txt`` or ``.json`` as ``list_file`` reads them."""

    first_names: str | None = None
    last_names: str | None = None
    stopwords: str | None = None


@dataclass(frozen=True)
class DetectOptions:
    """What a detection run does; ``profile`` gives the built-in ones: constants, config and lists."""

    patterns: dict[str, tuple[str, ...]] = field(default_factory=lambda: PATTERNS["config"])
    keywords: dict[str, tuple[str, ...]] = field(default_factory=lambda: KEYWORDS["config"])
    scores: dict[str, float] = field(default_factory=lambda: SCORES)
    scoring: Scoring = Scoring()
    luhn: LuhnRetype = LuhnRetype()
    address_filter: AddressFilter | None = AddressFilter()
    gateway: tuple[GatewayTest, ...] = (
        GatewayTest("consecutive_digits", True, 5), GatewayTest("name_dictionary"), GatewayTest("address_signals", True, 4),
    )
    gateway_enabled: bool = True
    context_window: int = 40
    detectors: tuple[str, ...] = DETECTORS
    passes: tuple[str, ...] = ("raw", "normalized")
    entity_types: tuple[str, ...] | None = None
    max_chars: int | None = None
    #: Words of the longest name looked for; None: as many as the longest name has.
    max_name_words: int | None = 3
    name_lists: NameLists = NameLists()

    def __post_init__(self):
        unknown = {"dict" if d == "dictionary" else d for d in self.detectors} - set(DETECTORS)
        if unknown:
            raise ValueError(f"unknown detectors {sorted(unknown)}")


@dataclass(frozen=True)
class EvalOptions:
    """How predictions are matched against gold, and how much of what went wrong is written."""

    match: str = "hybrid"
    overlap_min_chars: int = 1
    types: tuple[str, ...] = ("PERSON", "LOCATION", "ADDRESS", "SSN", "PHONE_NUMBER", "ACCOUNT_NUMBER", "DATE", "BIRTHDATE", "EMAIL")
    max_records: int = 0
    max_errors: int = 2000
    context: int = 50
    max_examples: int = 50
    proximity: int = 50


@dataclass(frozen=True)
class BenchOptions:
    glob: str = "*.txt"
    runs: int = 1
    warmup: int = 3
    max_pages: int = 0
    seed: int = 42
    shuffle: bool = False


@dataclass(frozen=True)
class SampleOptions:
    """Candidates of a corpus index."""

    n: int
    seed: int = 42
    prefer_text: bool = False
    scanned_share: float = 0.05
    page_buckets: str = "1,2-5,6-20,21+"
    size_buckets: tuple[str, ...] = ("tiny", "normal", "huge")
    output_field: str = "path"
    min_pages: int = 1
    max_pages: int = 0
    allow_duplicates: bool = False


@dataclass(frozen=True)
class SplitOptions:
    dev_ratio: float = 0.8
    seed: int = 42
    rare_types: tuple[str, ...] = ("SSN", "BIRTHDATE", "ACCOUNT_NUMBER")
    min_positives: int = 1


@dataclass(frozen=True)
class ValidateOptions:
    types: tuple[str, ...] = EvalOptions.types
    require_text: bool = True
    max_errors: int = 100
    strict: bool = False


def profile(name: str) -> DetectOptions:
    if name == "config":
        return DetectOptions()
    if name == "constants":
        return DetectOptions(
            patterns=PATTERNS["constants"],
            keywords=KEYWORDS["constants"],
            scoring=Scoring(account_no_context_score=0.40, account_min_digits=10),
            address_filter=None,
            gateway=(),
        )
    if name == "lists":  # the larger lists of context words, and the longer lists of patterns
        patterns = PATTERNS["config"] | {"PHONE_NUMBER": PHONE_LIST, "DATE": DATE_LIST, "ACCOUNT_NUMBER": PATTERNS["constants"]["ACCOUNT_NUMBER"]}
        return DetectOptions(patterns=patterns, keywords=keyword_lists.LISTS, scoring=Scoring(account_no_context_score=0.40, account_min_digits=10))
    raise ValueError(f"no profile {name!r}")


def override(base: DetectOptions, **request) -> DetectOptions:
    """A request's overrides on a base, which stays as it is; None values are passed over."""
    request = {k: v for k, v in request.items() if v is not None}
    changes = {}
    for key, to in (("patterns", "patterns"), ("context_keywords", "keywords"), ("scores", "scores")):
        if key in request:
            given = request.pop(key)
            changes[to] = {**getattr(base, to), **{k: v if key == "scores" else tuple(v) for k, v in given.items()}}
    if "min_digits_threshold" in request:
        digits = request.pop("min_digits_threshold")
        changes["gateway"] = tuple(
            dataclasses.replace(t, threshold=digits) if t.name == "consecutive_digits" else t for t in base.gateway
        )
    if "gateway_enabled" in request:
        changes["gateway_enabled"] = bool(request.pop("gateway_enabled"))
    if "detector_order" in request:
        changes["detectors"] = tuple(request.pop("detector_order"))
    for key in ("context_window",):
        if key in request:
            changes[key] = request.pop(key)
    if request:
        raise ValueError(f"cannot override {sorted(request)}")
    return dataclasses.replace(base, **changes)


def entity_types(options: DetectOptions) -> list[str]:
    """All types that the options name anywhere."""
    return sorted({*options.patterns, *options.keywords, *options.scores})


def list_file(path: str, *, config_dir: str | None = None, roots: tuple[str, ...] = (".", "src"), missing_ok: bool = False) -> list[str]:
    """A word or pattern list: ``.txt`` without blank and ``#`` lines, or a ``.json`` array; a gazetteer (``missing_ok``) that is absent is empty."""
    tried = [Path(path)] if Path(path).is_absolute() else [Path(r) / path for r in ((config_dir,) if config_dir else ()) + roots]
    found = next((p for p in tried if p.exists()), None)
    if found is None and missing_ok:
        return []
    if found is None:
        raise FileNotFoundError(f"{path}: not in {[str(p) for p in tried]}")
    if found.suffix == ".txt":
        lines = (x.strip() for x in found.read_text(encoding="utf-8").splitlines())
        return [x for x in lines if x and not x.startswith("#")]
    if found.suffix == ".json":
        data = json.loads(found.read_text(encoding="utf-8"))
        if not isinstance(data, list):
            raise ValueError(f"{found}: not an array")
        return [str(x) for x in data]
    raise ValueError(f"{found}: neither .txt nor .json")


def from_mapping(data: dict, config_dir: str | None = None) -> DetectOptions:
    """Options from a parsed configuration file; ``{"source": path}`` values are read from list files."""

    def values(x):
        return tuple(list_file(x["source"], config_dir=config_dir) if isinstance(x, dict) else x)

    changes: dict = {}
    for key, to in (("patterns", "patterns"), ("context_keywords", "keywords")):
        if key in data:
            changes[to] = {k: values(v) for k, v in data[key].items()}
    if "scores" in data:
        changes["scores"] = {**SCORES, **data["scores"]}
    if "scoring_rules" in data:
        changes["scoring"] = Scoring(**data["scoring_rules"])
    if "luhn_retype" in data:
        changes["luhn"] = LuhnRetype(**data["luhn_retype"])
    address = (data.get("post_filters") or {}).get("address_ner")
    if address is not None:
        changes["address_filter"] = AddressFilter(**{k: tuple(v) if isinstance(v, list) else v for k, v in address.items()})
    gate = data.get("gateway") or {}
    if "enabled" in gate:
        changes["gateway_enabled"] = bool(gate["enabled"])
    tests = gate.get("tests")
    if tests is not None:
        changes["gateway"] = tuple(GatewayTest(**t) for t in tests)
    if "context_window" in data:
        changes["context_window"] = data["context_window"]
    if "name_lists" in data:
        given = {k: v["source"] if isinstance(v, dict) else v for k, v in (data["name_lists"] or {}).items() if v}
        changes["name_lists"] = NameLists(**{k: str(Path(config_dir or ".") / v) if not Path(v).is_absolute() else v for k, v in given.items()})
    detection = data.get("detection") or {}
    if "detector_order" in detection:
        changes["detectors"] = tuple("dict" if d == "dictionary" else d for d in detection["detector_order"])
    if "passes" in detection:
        changes["passes"] = tuple(detection["passes"])
    return dataclasses.replace(DetectOptions(), **changes)


def load(path: str | None = None, search: tuple[str, ...] = ("pii_config.yaml", "config/pii_config.yaml")) -> DetectOptions:
    """Options from a YAML or JSON file; the defaults if there is none."""
    found = Path(path) if path else next((Path(p) for p in search if Path(p).exists()), None)
    if found is None:
        return DetectOptions()
    text = found.read_text(encoding="utf-8")
    if found.suffix == ".json":
        data = json.loads(text)
    else:
        import yaml  # optional

        data = yaml.safe_load(text) or {}
    return from_mapping(data, str(found.parent))
