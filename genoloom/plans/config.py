"""Settings of a run: YAML files in layers, templates, resources and the model registry. Driver side only.

Settings are kept flat, one value for each path of names. A layer's value takes the place of whatever stood at its
path, above it or below it; what it doesn't mention stays. Lists are values as a whole.

Templates hold ``{a.b}``: a given value or another setting, by its path. Names that are unknown stay as they are, so that
later steps can fill them; ``{{`` and ``}}`` stand for braces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import unquote

Names = tuple[str, ...]
_BRACES = re.compile(r"\{\{|\}\}|\{([^{}]*)\}")
_EMPTY: dict = {}


def _leaves(node: object, at: Names = ()) -> Iterator[tuple[Names, object]]:
    """Paths and values of a nested mapping; an empty mapping is a value."""
    todo = [(at, node)]
    while todo:
        path, value = todo.pop()
        if isinstance(value, Mapping) and value:
            todo.extend(((*path, str(k)), v) for k, v in reversed(value.items()))
        else:
            yield path, value


def fill(template: str, known: Mapping[str, object], braces: bool = True) -> str:
    """A template with the names that are known filled in; see the module's rule. ``braces=False`` leaves double ones."""

    def one(found: re.Match) -> str:
        if found[0] in ("{{", "}}"):
            return found[0][0] if braces else found[0]
        return str(known[found[1]]) if found[1] in known else found[0]

    return _BRACES.sub(one, template)


class Settings:
    """Layered settings; later layers win. Objects aren't changed once made."""

    def __init__(self, *layers: Mapping | None):
        self.values: dict[Names, object] = {}
        for layer in layers:
            for path, value in _leaves(layer or _EMPTY):
                if path:
                    self._put(path, value)

    def _put(self, path: Names, value: object) -> None:
        if value == {} and any(p[: len(path)] == path for p in self.values):
            return  # an empty mapping adds nothing to one that has entries
        n = len(path)
        self.values = {p: v for p, v in self.values.items() if p[:n] != path and path[: len(p)] != p}
        self.values[path] = value

    @classmethod
    def read(cls, *files: str | Path) -> Settings:
        """YAML files as layers; an empty file is an empty layer."""
        return cls(*map(read_yaml, files))

    def get(self, path: str, default: object = None) -> object:
        """The value at a dotted path, nested mappings as such."""
        want = tuple(path.split("."))
        if want in self.values:
            return self.values[want]
        below = {p[len(want) :]: v for p, v in self.values.items() if p[: len(want)] == want}
        return _nested(below) if below else default

    def __getitem__(self, path: str) -> object:
        found = self.get(path, _EMPTY)
        if found is _EMPTY:
            raise KeyError(path)
        return found

    def require(self, *paths: str) -> Settings:
        """These settings, or an error that names all of ``paths`` that are missing."""
        missing = [p for p in paths if self.get(p) is None]
        if missing:
            raise KeyError(f"settings are missing: {', '.join(missing)}")
        return self

    def nested(self) -> dict:
        return _nested(self.values)

    def resolved(self, **given: object) -> Settings:
        """Templates filled in from ``given`` (mappings by dotted names) and from plain settings; settings that are filled
        in serve others, so the order in which they stand doesn't matter."""
        extra = {".".join(p): v for p, v in _leaves(given)}
        out = Settings()
        out.values = dict(self.values)
        for _ in range(len(out.values) + 1):
            plain = {".".join(p): v for p, v in out.values.items() if isinstance(v, (str, int, float)) and not _BRACES.search(str(v))}
            now = {p: _filled(v, {**plain, **extra}, False) for p, v in out.values.items()}
            if now == out.values:
                break
            out.values = now
        out.values = {p: _filled(v, {}, True) for p, v in out.values.items()}
        return out

    def write(self, file: str | Path) -> None:
        write_yaml(self.nested(), file)


def _filled(value: object, known: Mapping[str, object], braces: bool) -> object:
    if isinstance(value, str):
        return fill(value, known, braces)
    if isinstance(value, (list, tuple)):
        return [_filled(v, known, braces) for v in value]
    return {k: _filled(v, known, braces) for k, v in value.items()} if isinstance(value, Mapping) else value


def _nested(values: Mapping[Names, object]) -> dict:
    out: dict = {}
    for path, value in values.items():
        at = out
        for name in path[:-1]:
            at = at.setdefault(name, {})
        at[path[-1]] = value
    return out


def _yaml():
    try:
        import yaml
    except ImportError as e:
        raise ImportError("reading and writing YAML needs PyYAML") from e
    return yaml


def read_yaml(file: str | Path) -> object:
    return _yaml().safe_load(Path(file).read_text())


def write_yaml(data: object, file: str | Path) -> None:
    """``data`` as YAML, keys in their order."""
    Path(file).write_text(_yaml().safe_dump(data, sort_keys=False, allow_unicode=True))


def feature_names(file: str | Path) -> list[str]:
    """A model's inputs in order from its YAML list; names may be URL-encoded."""
    return [unquote(str(n)) for n in read_yaml(file) or []]


def outputs_for(inputs: Iterable[str], pattern: str, output: str, allowed: Mapping[str, str] | None = None) -> list[str]:
    """The output path of each input that fits ``pattern``. ``{name}`` in it takes one or more characters, or what
    the regular expression under that name in ``allowed`` takes."""
    rules = dict(allowed or {})
    pieces = re.split(r"\{(\w+)\}", pattern)
    whole = "".join(f"(?P<{x}>{rules.get(x, '.+')})" if i % 2 else re.escape(x) for i, x in enumerate(pieces))
    return [fill(output, m.groupdict()) for m in map(re.compile(whole).fullmatch, inputs) if m]


def required_files(paths: list[str]) -> None:
    """An error that names all missing resources."""
    missing = [p for p in paths if not Path(p).exists()]
    if missing:
        raise FileNotFoundError(f"missing: {', '.join(missing)}")


GENOMES = ("hg19", "hg38")


def assembly(name: str, resources: Mapping[str, Mapping[str, str]]) -> dict[str, str]:
    """Resource paths of a genome assembly; an unknown one is an error."""
    if name not in GENOMES or name not in resources:
        raise ValueError(f"unknown genome assembly: {name}")
    return dict(resources[name])


def has_nmd(annotator_version: int) -> bool:
    """Whether the annotator's version writes the NMD column."""
    return annotator_version >= 105


@dataclass
class ModelSpec:
    """A registered model: feature lists and optional uses of its score. ``cutoffs`` and ``tissues`` apply on request only."""

    name: str
    features: list[str]
    variables: dict[str, list] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    fill: dict[str, object] = field(default_factory=dict)
    cutoffs: dict[str, float] = field(default_factory=dict)
    tissues: list[str] = field(default_factory=list)

    @classmethod
    def read(cls, name: str, feature_set: str | Path, features: str | Path, **more: object) -> ModelSpec:
        """A model from its feature-set file (variables, required_features, fill_values) and its list of inputs."""
        data = read_yaml(feature_set) or {}
        chosen = {k: list(v or []) for k, v in (data.get("variables") or {}).items()}
        return cls(name, feature_names(features), chosen, list(data.get("required_features") or []), dict(data.get("fill_values") or {}), **more)
