"""Configuration: a YAML tree, KEY=VALUE files, and the values derived from them."""

from __future__ import annotations

import os
from pathlib import Path
from typing import Any


def load(path: str) -> dict[str, Any]:
    """A YAML (where the parser is installed) or JSON file as a tree; a missing file raises."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        import json

        return json.loads(text)


def get(tree: dict, dotted: str, default: Any = None) -> Any:
    """A value by its dotted path, the default where any step is missing or null."""
    for k in dotted.split("."):
        if not isinstance(tree, dict) or tree.get(k) is None:
            return default
        tree = tree[k]
    return tree


def env_value(name: str, path: str = ".env") -> str | None:
    """From the environment, else from a KEY=VALUE file (quotes and comments taken away)."""
    if name in os.environ:
        return os.environ[name]
    if not os.path.exists(path):
        return None
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        k, sep, v = line.strip().partition("=")
        if sep and not k.startswith("#") and k.strip() == name:
            return v.strip().strip("\"'")
    return None


def groups(tree: dict) -> dict[str, dict]:
    """Enabled groups with their settings."""
    return {k: v or {} for k, v in (get(tree, "taxon_groups", {}) or {}).items() if (v or {}).get("enabled", True)}


def url_prefix(root_path: str | None) -> str:
    """A root path with one leading and no trailing slash; '' for none."""
    p = (root_path or "").strip().strip("/")
    return f"/{p}" if p else ""
