"""Where the data lives, from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path


def csv_variable(name: str) -> tuple[str, ...]:
    """Comma-separated values of an environment variable, blanks and repeats dropped, in order."""
    return tuple(dict.fromkeys(v.strip() for v in os.getenv(name, "").split(",") if v.strip()))


@dataclass(frozen=True)
class Settings:
    """Folders of raw files and of the layers: under a local folder, or a URI that Spark reads.

    ``salvage``: records with more fields than the header don't fail their file; they go to a table
    of their own with the reason, and the file's other rows are loaded.
    """

    data_dir: Path | str
    cors_origins: tuple[str, ...] = ()
    salvage: bool = False

    def _raw(self, name: str) -> Path | str:
        return self.data_dir / "raw" / name if isinstance(self.data_dir, Path) else f"{self.data_dir.rstrip('/')}/raw/{name}"

    @property
    def inbox(self) -> Path | str:
        return self._raw("inbox")

    @property
    def archive(self) -> Path | str:
        return self._raw("archive")

    @property
    def quarantine(self) -> Path | str:
        return self._raw("quarantine")

    @property
    def root(self) -> str:
        """The data folder as a URI."""
        return f"file://{self.data_dir}" if isinstance(self.data_dir, Path) else self.data_dir.rstrip("/")

    def layer(self, name: str) -> str:
        """URI of a layer's folder: control, bronze, silver or gold."""
        folder = {"control": "00_control", "bronze": "01_bronze", "silver": "02_silver", "gold": "03_gold"}[name]
        return f"{self.root}/lakehouse/{folder}"


def load_settings() -> Settings:
    """From WAYLEDGER_DATA_DIR (a path or a URI), WAYLEDGER_CORS_ORIGINS and WAYLEDGER_SALVAGE."""
    at = os.getenv("WAYLEDGER_DATA_DIR", "data")
    salvage = os.getenv("WAYLEDGER_SALVAGE", "").strip().lower() in ("1", "true", "yes")
    return Settings(at if "://" in at else Path(at).resolve(), csv_variable("WAYLEDGER_CORS_ORIGINS"), salvage)
