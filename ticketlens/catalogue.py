"""Field catalogue: which output column reads which ticket field, and how its values are normalised."""

from __future__ import annotations

from dataclasses import dataclass, field

from ticketlens.functions.normalise import SECONDS_PER_DAY


@dataclass(frozen=True)
class Header:
    """One output column. `own_name` claims a change item for this column alone."""

    name: str
    source: str
    step: int = 0
    own_name: str | None = None
    picks_id: bool = False
    change_step: str = "mod0"


@dataclass(frozen=True)
class Source:
    """One ticket field: names it has in change items, list or scalar, rule per step."""

    source: str
    names: tuple[str, ...]
    rules: dict[str, str] = field(default_factory=dict)
    is_list: bool = False


#: Rules that give numbers.
NUMBERS = ("float", "int")


@dataclass(frozen=True)
class Route:
    """Where a change item of one display name goes."""

    header: str
    picks_id: bool
    is_list: bool
    rule: str


@dataclass(frozen=True)
class Catalogue:
    headers: tuple[Header, ...]
    sources: tuple[Source, ...]
    seconds_per_day: int = SECONDS_PER_DAY

    def source(self, name: str) -> Source | None:
        return next((s for s in self.sources if s.source == name), None)

    def used_headers(self) -> list[Header]:
        """Columns with a source, in name order."""
        return sorted((h for h in self.headers if h.source), key=lambda h: h.name)

    def current_rule(self, header: Header) -> str | None:
        """How the column reads the current ticket. A field whose changes are numbers is a number there too."""
        source = self.source(header.source)
        if source is None:
            return None
        changes = source.rules.get(header.change_step)
        return source.rules.get("default" if header.step == 0 else str(header.step), changes if changes in NUMBERS else None)

    def restricted(self, sources: set[str]) -> Catalogue:
        """The catalogue of tickets that hold only these fields."""
        return Catalogue(tuple(h for h in self.headers if h.source in sources), self.sources, self.seconds_per_day)

    def twins(self) -> dict[str, str]:
        """Columns that read what an earlier one reads, of the ticket and of its changes, and that one: their history is the same."""
        seen: dict[str, list[tuple]] = {}
        for name, targets in self.routes().items():
            for r in targets:
                seen.setdefault(r.header, []).append((name, r.picks_id, r.is_list, r.rule))
        first: dict[tuple, str] = {}
        out = {}
        for h in self.headers if len({h.name for h in self.headers}) == len(self.headers) else ():
            if h.source and first.setdefault((h.source, self.current_rule(h), *seen.get(h.name, [])), h.name) != h.name:
                out[h.name] = first[h.source, self.current_rule(h), *seen.get(h.name, [])]
        return out

    def routes(self) -> dict[str, list[Route]]:
        """Display name of a change item -> the columns it changes."""
        used = {h.source for h in self.headers if h.source}
        out: dict[str, list[Route]] = {}
        for source in self.sources:
            for name in source.names if source.source in used else ():
                if name in out:
                    continue
                claimed = [h for h in self.headers if h.own_name == name]
                targets = claimed[:1] or [h for h in self.headers if h.source == source.source]
                out[name] = [
                    Route(h.name, h.picks_id, source.is_list, source.rules.get(h.change_step, "")) for h in targets
                ]
        return out


# Output columns in catalogue order
HEADERS = (
    Header("epic_agile_release_train", "customfield_16121"),
    Header("epic_agile_release_train_SAFe", "customfield_20203"),
    Header("epic_business_value", "customfield_10003"),
    Header("epic_components", "components"),
    Header("epic_customer_ref", "customfield_18051"),
    Header("epic_dev_cutoff", ""),
    Header("epic_dev_roadmap", "customfield_18300"),
    Header("epic_exec_status", "customfield_15143"),
    Header("epic_external_hld_status", "customfield_15102"),
    Header("epic_ext_ref", ""),
    Header("epic_feature_signoff", "customfield_16114", picks_id=True),
    Header("epic_fix_version", "fixVersions"),
    Header("epic_functional_area", "customfield_18055"),
    Header("epic_initiative_key", "customfield_21602"),
    Header("epic_jira_forecast_dev_etc_md", "timeoriginalestimate"),
    Header("epic_jira_remaining_dev_etc_md", "timetracking", step=1, own_name="timeestimate"),
    Header("epic_jira_spent_dev_etc_md", "timetracking", step=2, own_name="timespent"),
    Header("epic_labels", "labels"),
    Header("epic_level", "customfield_20200"),
    Header("epic_mgs_status", "customfield_14500"),
    Header("epic_owner", "customfield_18903"),
    Header("epic_owner_email", "customfield_18903", step=1, change_step="mod1"),
    Header("epic_PI", "fixVersions"),
    Header("epic_priority", "priority"),
    Header("epic_product_manager", "customfield_18901"),
    Header("epic_product_releases", "customfield_19004"),
    Header("epic_programs", "customfield_15700"),
    Header("epic_progress", "customfield_15114"),
    Header("epic_release_name", "fixVersions"),
    Header("epic_requirement_review_status", "customfield_15104"),
    Header("epic_risk_level", "customfield_15118"),
    Header("epic_scheduled_end", "customfield_13211"),
    Header("epic_scheduled_start", "customfield_13210", picks_id=True),
    Header("epic_service_order", "customfield_16803"),
    Header("epic_solution_manager", "customfield_18902"),
    Header("epic_solution_review_status", "customfield_15105"),
    Header("epic_status", "status"),
    Header("epic_strategy", "customfield_17004"),
    Header("epic_summary", "summary"),
    Header("epic_sync_parameters", "customfield_15101"),
    Header("epic_target_end", "customfield_12808", picks_id=True),
    Header("epic_target_start", "customfield_12807", picks_id=True),
    Header("epic_team", "customfield_12300"),
    Header("epic_versions", "versions"),
    Header("epic_sizing_task_records", "customfield_15401"),
)

# Ticket fields, their names in change items and their rules
# ("default", "1", "2" read the current ticket, "mod0", "mod1" read change items)
SOURCES = (
    Source("issuekey", ("key",)),
    Source("summary", ("summary",), {"default": "text", "mod0": "text"}),
    Source("customfield_18903", ("Epic Owner",), {"default": "display_name", "1": "email", "mod1": "email_of_name"}),
    Source("customfield_21602", ("Initiative KEY",), {"default": "key"}),
    Source("fixVersions", ("Fix Version",), {"default": "names"}, is_list=True),
    Source("status", ("status",), {"default": "name"}),
    Source("customfield_15104", ("RRM Status",), {"default": "value"}),
    Source("customfield_15105", ("SRM Status",), {"default": "value"}),
    Source("customfield_15401", ("Management Suite Record ID",)),
    Source("customfield_16803", ("Service Order ID",)),
    Source("versions", ("Version",), {"default": "names"}, is_list=True),
    Source("customfield_12807", ("Target start",)),
    Source("labels", ("labels",), {"default": "strings", "mod0": "words"}),
    Source("customfield_15101", ("Ext System Sync Parameters",), {"default": "strings", "mod0": "words"}),
    Source("customfield_15143", ("Lead time (SSA)",)),
    Source("customfield_15118", ("Status report (SSA)",)),
    Source("customfield_12808", ("Target end",)),
    Source("customfield_14500", ("Requirements",), {"default": "strings", "mod0": "words"}),
    Source("customfield_16114", ("Feature Sign-off date",)),
    Source("customfield_18051", ("Customer",)),
    Source("customfield_18300", ("Development Roadmap",), {"default": "names"}),
    Source("customfield_17004", ("Strategy",), {"default": "strings", "mod0": "words"}),
    Source("customfield_10003", ("Business Value",), {"mod0": "float"}),
    Source("components", ("Component",), {"default": "names"}, is_list=True),
    Source("customfield_18902", ("Solution Manager",), {"default": "display_name"}),
    Source("customfield_19004", ("Product Release",), {"default": "names", "mod0": "words"}),
    Source("customfield_13211", ("Scheduled End Date",)),
    Source("priority", ("priority",), {"default": "name"}),
    Source("customfield_10900", ("Rank",)),
    Source("customfield_18055", ("Functional area",), {"default": "values"}, is_list=True),
    Source("customfield_18901", ("Product Manager",), {"default": "display_name"}),
    Source("customfield_13210", ("Scheduled Start Date",)),
    Source("customfield_15114", ("Progress Indicator (%)",), {"mod0": "int"}),
    Source("timeoriginalestimate", ("timeoriginalestimate",), {"default": "days", "mod0": "days"}),
    Source("timetracking", ("timespent", "timeestimate"), {"1": "remaining_days", "2": "spent_days", "mod0": "days"}),
    Source("customfield_20200", ("Epic Level",), {"default": "value"}),
    Source("customfield_15102", ("External HLD Status",), {"default": "value"}),
    Source("customfield_12300", ("Team",), {"default": "name"}),
    Source("customfield_16121", ("Agile Release Train",), {"default": "value"}),
    Source("customfield_20203", ("Agile Release Train (SAFe)",), {"default": "values"}),
    Source("customfield_15700", ("Customer Programs",), {"default": "values", "mod0": "words"}),
)

DEFAULT = Catalogue(HEADERS, SOURCES)
