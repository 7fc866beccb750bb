"""What a panel user can choose."""

from __future__ import annotations

from dataclasses import dataclass

# The offered choices, the range of the rating slider and the reset state.
COUNTRY_CHOICES = (
    "United States", "Turkey", "Brazil", "Australia", "Canada", "China", "Hong Kong", "Portugal",
)
LOWEST_RATING = 20
HIGHEST_RATING = 100
DEFAULT_COUNTRY = "United States"
DEFAULT_RATING = 20


@dataclass(frozen=True)
class Params:
    """Chosen countries and the lowest rating to include; any country value is accepted."""

    countries: tuple[str, ...] = (DEFAULT_COUNTRY,)
    min_rating: int = DEFAULT_RATING

    def __post_init__(self) -> None:
        if isinstance(self.countries, str):
            object.__setattr__(self, "countries", (self.countries,))
        if not self.countries:
            raise ValueError("choose at least one country")
        if not LOWEST_RATING <= self.min_rating <= HIGHEST_RATING:
            raise ValueError(f"ratings run from {LOWEST_RATING} to {HIGHEST_RATING}")

    @classmethod
    def reset(cls) -> Params:
        return cls()
