"""What a run can be told."""

from collections.abc import Callable
from dataclasses import dataclass, field

from kinlink.functions import text
from kinlink.operators.rules import M1, M2, M3, M4, M5, Rule


@dataclass(frozen=True)
class Phase:
    """Rules tried inside blocks of ``key``, for rows that also know ``other``."""

    number: int
    key: str
    other: str
    rules: tuple[Rule, ...]
    vectors: bool = False


PHASES = (
    Phase(1, "Zip_UPDATED", "City_UPDATED", (M1, M2)),
    Phase(2, "City_UPDATED", "Zip_UPDATED", (M1, M2)),
    Phase(3, "Zip_UPDATED", "City_UPDATED", (M3, M4, M5), vectors=True),
)


@dataclass(frozen=True)
class Settings:
    abbreviations: dict[str, str] = field(default_factory=dict)
    directions: dict[str, str] = field(default_factory=lambda: dict(text.DIRECTIONS))
    numbers: dict[str, str] = field(default_factory=lambda: dict(text.NUMBER_WORDS))
    common_words: tuple[str, ...] = tuple(text.COMMON_WORDS)
    legal_suffixes: tuple[str, ...] = tuple(text.LEGAL_SUFFIXES)
    phases: tuple[Phase, ...] = PHASES
    fill_missing: bool = False
    missing_ids: str = "group"
    keep_uncoded: bool = False
    strict: bool = True
    make_encoder: Callable | None = None

    @property
    def name_lists(self) -> tuple:
        return self.directions, self.numbers, self.common_words, self.legal_suffixes

    def cleaning(self) -> list:
        """What the cleaned tables depend on."""
        return [self.abbreviations, *self.name_lists, self.strict]

    def survivorship(self) -> list:
        """What the survivors depend on besides."""
        return [self.missing_ids, self.keep_uncoded]

    def matching(self) -> list:
        """What the matches of a phase depend on besides its rules."""
        return [self.fill_missing, self.make_encoder]
