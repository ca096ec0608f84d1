"""Parameters of one mailing run."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping

from muster.functions import dates


def _texts(value: str) -> tuple[str, ...]:
    return tuple(part.strip() for part in value.split(","))


def _numbers(value: str) -> tuple[int, ...]:
    return tuple(int(part) for part in value.split(","))


# Names of the variables that set up a job.
_VARIABLES = {
    "ds": ("DS", dt.date.fromisoformat),
    "mailing_name": ("MAILING_NAME", str),
    "invite_lead_days": ("INVITE_LEAD_DAYS", int),
    "quiet_period_days": ("QUIET_PERIOD_DAYS", int),
    "max_recipients_per_spot": ("MAX_RECIPIENTS_PER_SPOTS_REMAINING", int),
    "radius": ("RADIUS", float),
    "state_whitelist": ("STATE_WHITELIST", _texts),
    "state_blacklist": ("STATE_BLACKLIST", _texts),
    "tag_ids": ("TAG_ID_WHITELIST", _numbers),
    "event_types": ("EVENT_TYPE_WHITELIST", _texts),
}


@dataclasses.dataclass(frozen=True)
class MailingConfig:
    """Everything a scheduling job needs to know besides its tables.

    ``ds`` is the day the mail is meant to go out.  Empty tuples mean "no
    restriction", except ``event_types``, which always restricts.
    """

    ds: dt.date
    mailing_name: str
    invite_lead_days: int = 3
    quiet_period_days: int = 3
    radius: float = 25.0
    max_recipients_per_spot: int = 5000
    chapter_id: int = 1
    state_whitelist: tuple[str, ...] = ()
    state_blacklist: tuple[str, ...] = ()
    tag_ids: tuple[int, ...] = ()
    event_types: tuple[str, ...] = ("CANVASS",)
    base_url: str = "https://events.example.org"
    calendar_zone: str = "America/New_York"
    approval_excluded_states: tuple[str, ...] = ("IA", "NH", "NV", "SC")
    approval_lookback_days: int = 30
    approved_since: dt.datetime = dt.datetime(2019, 7, 19, 0, 0)  # UTC

    def __post_init__(self):
        if not self.mailing_name:
            raise ValueError("mailing_name must not be empty")
        if not self.event_types:
            raise ValueError("event_types must name at least one type")
        if self.radius <= 0:
            raise ValueError("radius must be positive")

    @classmethod
    def from_env(cls, env: Mapping[str, str], **settings) -> MailingConfig:
        """Configuration from job variables, lists separated by commas.

        A variable that is missing or empty leaves its default.
        """
        for field, (variable, parse) in _VARIABLES.items():
            if env.get(variable):
                settings[field] = parse(env[variable])
        return cls(**settings)

    def on(self, ds: dt.date) -> MailingConfig:
        """The same mailing on another day."""
        return dataclasses.replace(self, ds=ds)

    @property
    def event_ds(self) -> dt.date:
        return self.ds + dt.timedelta(days=self.invite_lead_days)

    @property
    def window_end_ds(self) -> dt.date:
        """First day after the days whose events compete for a recipient."""
        return self.event_ds + dt.timedelta(days=dates.window_days(self.event_ds))

    @property
    def showcase_end_ds(self) -> dt.date:
        """First day after the days whose timeslots are listed in the mail."""
        return self.event_ds + dt.timedelta(days=dates.SHOWCASE_DAYS)

    @property
    def quiet_start_ds(self) -> dt.date:
        return self.ds - dt.timedelta(days=self.quiet_period_days - 1)

    @property
    def approval_start_ds(self) -> dt.date:
        return self.ds - dt.timedelta(days=self.approval_lookback_days)
