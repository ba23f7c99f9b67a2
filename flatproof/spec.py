"""Record layouts as data: field specs, record specs and the layout files.

A field is written ``Name:kind[min..max]{a|b|c}=default``:

* ``[min..max]`` is the length range, ``[max]`` an upper bound only;
* ``*`` after the kind or the range marks a required field (minimum length one);
* ``{...}`` lists the allowed values, ``{$name}`` refers to a named list, and
  ``{<BLANK>}`` forces an empty value;
* ``<lo..hi>`` is a numeric range and ``=value`` the default for a blank field.
"""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass, replace
from functools import cache
from importlib import resources

KINDS = (
    "any", "text", "ssn", "email", "zip", "phone", "alnum", "alnumdash", "alpha", "alphadash",
    "numdash", "int", "decimal", "money", "const", "isodate", "usdate", "isodatetime",
    "usdatetime", "yesno", "flag", "truefalse",
)
BLANK_ONLY = "<BLANK>"

_FIELD = re.compile(
    r"^(?P<name>[^:]+):(?P<kind>[a-z]+)"
    r"(?:\[(?P<lo>\d+\.\.)?(?P<hi>\d*)\])?"
    r"(?P<req>\*)?"
    r"(?:<(?P<vlo>-?\d+)\.\.(?P<vhi>-?\d+)>)?"
    r"(?:\{(?P<allowed>.*?)\})?"
    r"(?:=(?P<default>.*))?$"
)


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str = "any"
    min_len: int = 0
    max_len: int = 0
    allowed: tuple[str, ...] = ()
    default: str = ""
    min_value: int = 0
    max_value: int = 0

    @property
    def required(self) -> bool:
        return self.min_len > 0

    @property
    def fixed(self) -> str:
        """The constant of a ``const`` field."""
        return self.allowed[0] if self.allowed else ""


@dataclass(frozen=True)
class RecordSpec:
    code: str
    fields: tuple[FieldSpec, ...]
    header_type: str = "New"
    title: str = ""

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def width(self) -> int:
        """Columns of a line: the record code and its fields."""
        return len(self.fields) + 1

    def __getitem__(self, name: str) -> FieldSpec:
        return next(f for f in self.fields if f.name == name)


def parse_field(text: str, lists: dict[str, list[str]] | None = None) -> FieldSpec:
    match = _FIELD.match(text.strip())
    if not match:
        raise ValueError(f"bad field spec: {text!r}")
    g = match.groupdict()
    if g["kind"] not in KINDS:
        raise ValueError(f"unknown kind in field spec: {text!r}")
    allowed = g["allowed"] or ""
    values = (lists or {})[allowed[1:]] if allowed.startswith("$") else allowed.split("|") if allowed else []
    low = int(g["lo"][:-2]) if g["lo"] else 0
    return FieldSpec(
        name=g["name"],
        kind=g["kind"],
        min_len=max(low, 1) if g["req"] else low,
        max_len=int(g["hi"]) if g["hi"] else 0,
        allowed=tuple(values),
        default=g["default"] or "",
        min_value=int(g["vlo"] or 0),
        max_value=int(g["vhi"] or 0),
    )


def record(code: str, fields: list[str], header_type: str = "New", lists=None, title: str = "") -> RecordSpec:
    return RecordSpec(code, tuple(parse_field(f, lists) for f in fields), header_type, title)


@cache
def _layout_file(name: str) -> dict:
    text = resources.files("flatproof.layouts").joinpath(f"{name}.toml").read_text(encoding="utf-8")
    return tomllib.loads(text)


@cache
def platform_a_catalogue() -> dict[str, dict]:
    """Record code -> title, whether it is a header and whether it is a result record."""
    return _layout_file("platform_a")["catalogue"]


@cache
def platform_a_layouts(tpa_id: str = "TPA01") -> dict[tuple[str, str], RecordSpec]:
    """Layouts of platform A keyed by (record code, header type)."""
    data = _layout_file("platform_a")
    out: dict[tuple[str, str], RecordSpec] = {}
    for code, entry in data["records"].items():
        lists = {**data.get("lists", {}), "tpa": [tpa_id]}
        full = record(code, entry["fields"], "New", lists, entry["title"])
        out[code, "New"] = full
        for header_type, dropped in entry.get("without", {}).items():
            kept = tuple(f for f in full.fields if f.name not in dropped)
            out[code, header_type] = replace(full, fields=kept, header_type=header_type)
        for header_type, added in entry.get("with", {}).items():
            extra = tuple(parse_field(f, lists) for f in added)
            out[code, header_type] = replace(full, fields=full.fields + extra, header_type=header_type)
        for header_type in entry.get("same", []):
            out[code, header_type] = replace(full, header_type=header_type)
    return out


@cache
def platform_a_header_rules() -> dict[str, dict[int, str]]:
    """Record code -> column count of the first data row -> header type."""
    rules = _layout_file("platform_a")["header_by_columns"]
    return {code: {int(n): h for n, h in counts.items()} for code, counts in rules.items()}


@cache
def platform_c_layouts() -> dict[str, RecordSpec]:
    """Layouts of platform C keyed by bracket code; versions 1.0, 1.1 and 1.2 share them."""
    data = _layout_file("platform_c")
    return {
        code: record(code, entry["fields"], lists=data["lists"]) for code, entry in data["records"].items()
    }


@cache
def platform_c_versions() -> tuple[str, ...]:
    return tuple(_layout_file("platform_c")["versions"])


@cache
def csv_layout(name: str) -> RecordSpec:
    """Layouts of the plain CSV inputs (invoice export, account managers, master data)."""
    return record(name, _layout_file("tables")[name]["fields"])
