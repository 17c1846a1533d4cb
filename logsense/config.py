"""Settings, as frozen dataclasses that the operators take as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: the default log layout -------------------------------------------------
# Patterns are written in Python syntax and are translated to Java's when compiled.
START_REGEXES = (
    r"^\[\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:[.,]\d{3})?\]",
    r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}",
)
ENTRY_PATTERNS = (
    r"^\[(?P<timestamp>.*?)\]\s*\[(?P<level>\w+)\s*\]\s*\[(?P<component>[-:.\w]+)\s*\]\s*"
    r"\[\s*(?P<pid>\d+):\s*(?P<tid>\d+)\s*\]\s*"
    r"\[(?P<file_guid_prefix>[A-Za-z0-9]+):\s*(?P<line_no>\d+)\s*\]\s*(?P<message>.*)$",
    r"^\[(?P<timestamp>.*?)\]\s*(?P<pid>\d+)\s*(?P<message>.*)$",
)
LEVEL_MAP = {"fnction": "FUNCTION"}
USER_STRINGS = ("admin", "root", "null", "C++")
# ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ParserConfig:
    patterns: tuple[str, ...] = ENTRY_PATTERNS
    level_map: dict[str, str] = field(default_factory=lambda: dict(LEVEL_MAP))
    multiline: bool = True
    start_regexes: tuple[str, ...] = START_REGEXES
    join_with: str = " "
    max_lines: int = 2000  # 0 = no limit


@dataclass(frozen=True)
class MinerConfig:
    similarity: float = 0.65
    depth: int = 5
    max_children: int = 100
    user_strings: tuple[str, ...] = USER_STRINGS
    apply_correction: bool = False

    @property
    def routed_tokens(self) -> int:
        """Root is level 1 and token count level 2; the leaves take one, the rest route by token."""
        return max(self.depth - 3, 0)


@dataclass(frozen=True)
class ClusterConfig:
    method: str = "kmeans"  # anything else means mini-batch
    k: int | None = None  # an int > 1 skips the sweep
    k_start: int = 2
    k_stop: int = 50
    k_step: int = 2
    batch_size: int = 2048
    max_iter: int = 100
    epochs: int = 1
    n_init: int = 1
    seed: int = 42
    percentile: float = 99.0
    sample_size: int = 10000
