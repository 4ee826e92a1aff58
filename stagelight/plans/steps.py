"""Pipeline steps as a graph: validation, order and error policies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# The standard steps and what each needs.
DEPENDENCIES = {
    "ingestion": (), "parse": ("ingestion",), "normalize": ("parse",), "quality_gate": ("normalize",), "enrich": ("quality_gate",), "conflation": ("enrich",), "catalog": ("conflation",),
}
POLICIES = ("stop", "continue", "skip")


@dataclass
class Step:
    name: str
    run: Callable[[dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    enabled: bool = True


@dataclass
class Plan:
    steps: list[Step]
    on_error: str = "stop"
    results: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def validate(self) -> list[Step]:
        """Enabled steps in an order that respects needs; ValueError for unknown policies, missing needs and cycles."""
        if self.on_error not in POLICIES:
            raise ValueError(f"unknown policy {self.on_error}")
        on = {s.name: s for s in self.steps if s.enabled}
        for s in on.values():
            if missing := [n for n in s.needs if n not in on]:
                raise ValueError(f"{s.name} needs {', '.join(missing)}")
        out: list[Step] = []
        left = dict(on)
        while left:
            ready = [s for s in left.values() if not any(n in left for n in s.needs)]
            if not ready:
                raise ValueError("cycle among " + ", ".join(left))
            for s in ready:
                out.append(left.pop(s.name))
        return out

    def run(self) -> dict[str, DataFrame]:
        """stop: the first error ends the run; continue: later steps still run where their needs are met; skip: as
        continue, and a failed step passes on what its first need gave."""
        for s in self.validate():
            if all(n in self.results for n in s.needs):
                try:
                    self.results[s.name] = s.run(self.results)
                except Exception as e:
                    if self.on_error == "stop":
                        raise
                    self.errors[s.name] = str(e)
                    if self.on_error == "skip" and s.needs:
                        self.results[s.name] = self.results[s.needs[0]]
        return self.results


def parse_only(run: Callable) -> Plan:
    """A plan of one step, without the needs it has in a full run."""
    return Plan([Step("parse", run)])
