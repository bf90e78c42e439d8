"""Settings, template files and local archives."""

from __future__ import annotations

import json
import os
import shutil
import zipfile
from dataclasses import dataclass, field
from functools import lru_cache

try:
    import yaml
except ImportError:  # JSON files, which are YAML too, can still be read
    yaml = None


def load(path: str) -> dict:
    """Settings of a YAML or JSON file (S12); ValueError if they are no mapping."""
    with open(path, encoding="utf-8-sig") as f:
        text = f.read()
    got = yaml.safe_load(text) if yaml else json.loads(text)
    if not isinstance(got, dict):
        raise ValueError(f"{path} holds no mapping")
    return got


@dataclass(frozen=True)
class Sampling:
    """Settings of a weighted draw."""

    target: int
    seed: int = 42
    max_oversample: float = 3.0
    domain_weights: dict[str, float] = field(default_factory=dict)
    source_weights: dict[str, dict[str, float]] = field(default_factory=dict)

    @classmethod
    def of(cls, settings: dict) -> Sampling:
        known = {k: settings[k] for k in cls.__dataclass_fields__ if k in settings}
        if "target" not in known or unknown_domains(known):
            raise ValueError("target is missing, or a domain has sources but no weight")
        return cls(**known)


def unknown_domains(settings: dict) -> set[str]:
    return set(settings.get("source_weights", {})) - set(settings.get("domain_weights", {}))


@lru_cache(maxsize=256)
def template(path: str) -> str:
    """Text of a template file, read once."""
    with open(path, encoding="utf-8-sig") as f:
        return f.read()


def templates(folder: str, suffixes: tuple[str, ...] = (".txt", ".md")) -> dict[str, str]:
    """Templates of a folder by their file names without suffix."""
    return {os.path.splitext(n)[0]: template(os.path.join(folder, n)) for n in sorted(os.listdir(folder)) if n.endswith(suffixes)}


def unpacked(archive: str, folder: str) -> str:
    """Unpack a local zip archive to folder once and return the folder of its contents (S9): a single top folder is left out. A
    folder that exists is taken as it is; members outside the folder are an error."""
    if not os.path.isdir(folder):
        tmp = f"{folder}.new"
        shutil.rmtree(tmp, ignore_errors=True)
        with zipfile.ZipFile(archive) as z:
            root = os.path.realpath(tmp)
            for n in z.namelist():
                if not os.path.realpath(os.path.join(tmp, n)).startswith(root + os.sep):
                    raise ValueError(f"member outside the folder: {n}")
            z.extractall(tmp)
        inside = [n for n in os.listdir(tmp) if n != "__MACOSX"]
        top = os.path.join(tmp, inside[0]) if len(inside) == 1 else tmp
        os.rename(top if os.path.isdir(top) else tmp, folder)
        shutil.rmtree(tmp, ignore_errors=True)
    return folder
