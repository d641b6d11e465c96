"""Settings of a corpus run: profiles, variants and manifests, with hashes of what results depend on."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import types as T


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value: Any, length: int = 16) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()[:length]


@dataclass(frozen=True)
class Unit:
    name: str
    pattern: str
    level: int


@dataclass(frozen=True)
class Profile:
    """How documents of one kind read. The version is part of the name."""

    name: str
    version: str
    units: tuple[Unit, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    authority: Mapping[str, int] = field(default_factory=dict)
    boilerplate: tuple[str, ...] = ()
    terms: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [u.name for u in self.units]
        if len(names) != len(set(names)):
            raise ValueError(f"{self.ref}: two units have one name")
        for u in self.units:
            if not 1 <= u.level <= 9:
                raise ValueError(f"{self.ref}: level {u.level} of {u.name}")

    @property
    def ref(self) -> str:
        return f"{self.name}@{self.version}"

    def structure_hash(self) -> str:
        """Of what extraction depends on alone."""
        return digest([asdict(u) for u in self.units])

    def config_hash(self) -> str:
        return digest({"ref": self.ref, "units": [asdict(u) for u in self.units], "types": dict(self.types), "authority": dict(self.authority), "boilerplate": self.boilerplate, "terms": self.terms})

    def scoring(self) -> str:
        """What scores depend on, as JSON: each type with its short form and rank (null if it has none)."""
        ranks = {t: self.authority.get(t) for t in self.types}
        return canonical({"profile": self.ref, "types": [{"type": t, "short": s, "rank": ranks[t]} for t, s in sorted(self.types.items())], "top": max((r for r in ranks.values() if r is not None), default=None)})

    def deepest_units(self) -> tuple[str, ...]:
        """Where chunks are split unless something else is said: the units of the greatest level."""
        level = max((u.level for u in self.units), default=None)
        return tuple(u.name for u in self.units if u.level == level)

    def document_type(self, title: str) -> str | None:
        """The longest type that the title contains."""
        held = [t for t in self.types if t in title.upper()]
        return max(held, key=lambda t: (len(t), t), default=None)

    def cite(self, document_type: str, number: str, year: int) -> str:
        """Short form; a number that names its year already is not given it twice."""
        short = self.types.get(document_type, document_type)
        return f"{short} {number}" if number.endswith(f"/{year}") else f"{short} {number}/{year}"


@dataclass(frozen=True)
class ChunkConfig:
    chunker: str = "heading"
    max_tokens: int = 400
    min_tokens: int = 0
    overlap_tokens: int = 0
    max_level: int = 9
    include_tables: bool = True
    carry_lead: bool = True

    def config_hash(self) -> str:
        return digest(asdict(self))

    def over(self, settings: Mapping[str, Any]) -> ChunkConfig:
        """These settings with others laid over them; None leaves a setting as it is."""
        return replace(self, **{k: v for k, v in settings.items() if v is not None})


def generation(root: str, stage: str, settings: Mapping[str, Any]) -> str:
    """The folder of a stage's results under these settings; other settings never meet in it."""
    return f"{root.rstrip('/')}/{stage}/{digest([stage, dict(settings)])}"


@dataclass(frozen=True)
class Variant:
    """Settings of each stage, in order. A stage's key holds all stages before it."""

    name: str
    stages: tuple[tuple[str, Mapping[str, Any]], ...]

    def __post_init__(self) -> None:
        for stage, settings in self.stages:
            if any(v is None for v in settings.values()):
                raise ValueError(f"{self.name}: {stage} has a setting of None")

    def keys(self) -> dict[str, str]:
        out, before = {}, ""
        for stage, settings in self.stages:
            before = digest([before, stage, dict(settings)])
            out[stage] = before
        return out

    def shares_with(self, other: Variant) -> list[str]:
        mine, theirs = self.keys(), other.keys()
        return [s for s in mine if mine[s] == theirs.get(s)]


def matrix(base: Variant, axes: Mapping[tuple[str, str], Iterable[Any]]) -> list[Variant]:
    """A variant for every combination of the axes' values, in the order of their names."""
    out = []
    names = sorted(axes)
    for values in itertools.product(*(list(axes[n]) for n in names)):
        put = dict(zip(names, values, strict=True))
        stages = tuple((s, {**dict(p), **{k: v for (stage, k), v in put.items() if stage == s}}) for s, p in base.stages)
        out.append(Variant(f"{base.name}:" + ",".join(f"{s}.{k}={v}" for (s, k), v in put.items()), stages))
    return out


def reuse(variants: list[Variant]) -> dict[str, int]:
    """How many distinct runs each stage needs."""
    runs: dict[str, set[str]] = {}
    for v in variants:
        for stage, key in v.keys().items():
            runs.setdefault(stage, set()).add(key)
    return {s: len(k) for s, k in runs.items()}


@dataclass(frozen=True)
class Manifest:
    """Recipe and inventory of a bundle. The fingerprint leaves out what does not change results."""

    recipe: Mapping[str, Any]
    counts: Mapping[str, int]
    checksums: Mapping[str, str]
    run: Mapping[str, Any] = field(default_factory=dict)

    def fingerprint(self) -> str:
        return digest({"recipe": dict(self.recipe), "counts": dict(self.counts)}, 64)

    def differences(self, other: Manifest) -> list[str]:
        """Recipe fields that differ, by name."""
        return sorted(k for k in {*self.recipe, *other.recipe} if self.recipe.get(k) != other.recipe.get(k))

    def to_json(self) -> str:
        return canonical(asdict(self))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_table(name: str, schema: T.StructType, *, cluster_by: str | None = None, buckets: int = 0) -> str:
    """The statement that makes a table of this schema."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    tail = f" CLUSTERED BY ({quoted(cluster_by)}) INTO {buckets} BUCKETS" if cluster_by and buckets else ""
    return f"CREATE TABLE {quoted(name)} ({columns}) USING parquet{tail}"
