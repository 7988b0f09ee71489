"""Where the stages of a flow keep their tables, records and models."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def data(self, part: str) -> str:
        """Raw rows of a part: initial, new or held_out."""
        return f"{self.root}/data/split={part}"

    def processed(self, part: str) -> str:
        return f"{self.root}/processed/{part}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"

    def record(self, name: str) -> str:
        return f"{self.root}/records/{name}"

    @property
    def splits(self) -> str:
        return f"{self.root}/data"

    @property
    def state(self) -> str:
        return f"{self.root}/processed/prep_state"

    @property
    def registry(self) -> str:
        return f"{self.root}/models/registry"

    @property
    def ledger(self) -> str:
        return f"{self.root}/records/runs"
