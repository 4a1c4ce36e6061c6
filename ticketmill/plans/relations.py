"""Raw items -> the five relations and their rejects, as lazy plans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill import params
from ticketmill.operators.boards import check_boards
from ticketmill.operators.dedupe import without_present
from ticketmill.operators.issues import check_issues
from ticketmill.operators.projects import check_projects
from ticketmill.operators.releases import check_releases
from ticketmill.operators.transitions import check_transitions
from ticketmill.operators.validity import good, rejects
from ticketmill.schemas import DATA_TYPES, LOAD_ORDER, REJECTS, TRACKED_FIELDS
from ticketmill.sources.pages import (
    board_of_request,
    items,
    paged_items,
    project_of_request,
    projects_by_key,
    scan_details,
    scan_pages,
    torn_rejects,
    whole_pages,
)
from ticketmill.sources.storage import Stage, unstaged


@dataclass(frozen=True)
class Raw:
    """Raw items, one JSON text (``body``) per row.

    projects(body), details(path, body), boards(project_key, ord, body),
    issues(board_id, ord, body). ``ord`` is the entry's place in its listing;
    any orderable type will do. One frame holds one crawl of the tracker.
    """

    projects: DataFrame
    details: DataFrame
    boards: DataFrame
    issues: DataFrame | None = None
    torn: DataFrame | None = None
    """Landed lines that are no JSON, in the columns of rejects."""


def board_items(pages: DataFrame, stage: Stage = unstaged) -> DataFrame:
    """Board listings: the paged items keyed by the project they were read for."""
    return paged_items(pages, stage, "board_strays").select(
        project_of_request(F.col("request_id")).alias("project_key"), "ord", "body"
    )


def issue_items(
    pages: DataFrame, stage: Stage = unstaged, earlier: DataFrame | None = None
) -> DataFrame:
    """Issue listings: the paged items keyed by the board they were read for.

    ``earlier`` is the ledger of pages that earlier batches have read.
    """
    return paged_items(pages, stage, "issue_strays", earlier).select(
        board_of_request(F.col("request_id")).alias("board_id"), "ord", "body"
    )


def landed(
    spark: SparkSession,
    uri: str,
    stage: Stage = unstaged,
    issue_pages: DataFrame | None = None,
    earlier: DataFrame | None = None,
    multi_line: bool = False,
) -> Raw:
    """Raw items of a landing folder: projects/, details/, boards/ and issues/.

    ``issue_pages`` takes the place of the issues folder, as a micro-batch does,
    and ``earlier`` is the ledger of the pages before it. With a stage that
    writes, landed files are read once: the stop rule reads the ledger columns
    of the staged pages, the items their payload, and torn lines are kept.
    """
    uri = params.root(uri)
    if issue_pages is None:
        issue_pages = stage(scan_pages(spark, f"{uri}/issues", multi_line), "issue_pages")
    dimensions = landed_dimensions(spark, uri, stage, multi_line)
    return replace(
        dimensions,
        issues=issue_items(issue_pages, stage, earlier),
        torn=dimensions.torn.unionByName(torn_rejects(issue_pages)),
    )


def landed_dimensions(
    spark: SparkSession, uri: str, stage: Stage = unstaged, multi_line: bool = False
) -> Raw:
    """Projects, details and boards of a landing folder, without issues."""
    uri = params.root(uri)
    project_pages = stage(scan_pages(spark, f"{uri}/projects", multi_line), "project_pages")
    board_pages = stage(scan_pages(spark, f"{uri}/boards", multi_line), "board_pages")
    details = stage(scan_details(spark, f"{uri}/details", multi_line), "detail_pages")
    torn = [torn_rejects(pages) for pages in (project_pages, board_pages)]
    return Raw(
        projects=items(whole_pages(project_pages)).select("body"),
        details=whole_pages(details).drop("torn"),
        boards=board_items(board_pages, stage),
        torn=reduce(DataFrame.unionByName, [*torn, torn_rejects(details, "path")]),
    )


@dataclass(frozen=True)
class Relations:
    """Checked frames of one build. Each carries record columns, ``reason`` and ``raw``."""

    data_types: tuple[str, ...]
    checked: Mapping[str, DataFrame]
    torn: DataFrame | None = None

    def __getitem__(self, relation: str) -> DataFrame:
        """The valid rows of one selected relation."""
        if relation not in self.data_types:
            raise KeyError(f"{relation!r} was not selected")
        return good(self.checked[relation], relation)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self[name]) for name in self.data_types]

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.items())

    def loadable(self) -> dict[str, DataFrame]:
        """The same rows with the columns that say which of two alike came first."""
        return {
            name: good(self.checked[name], name, LOAD_ORDER[name]) for name in self.data_types
        }

    def rejects(self) -> DataFrame:
        """Torn lines and the invalid rows of every relation that had to be built."""
        parts = [rejects(df, name) for name, df in self.checked.items()]
        if self.torn is not None:
            parts.append(self.torn)
        return reduce(DataFrame.unionByName, parts).to(REJECTS)

    def only(self, *names: str, torn: DataFrame | None = None) -> Relations:
        """These relations alone, with other torn lines."""
        chosen = tuple(name for name in self.data_types if name in names)
        return Relations(chosen, {n: df for n, df in self.checked.items() if n in names}, torn)


def build(
    raw: Raw,
    data_types: str | Iterable[str] | None = None,
    project_keys: str | Iterable[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    custom_fields: str | Mapping[str, str] | None = None,
    stage: Stage = unstaged,
    seen: DataFrame | None = None,
    ready: Mapping[str, DataFrame] | None = None,
    transition_fields: Iterable[str] = TRACKED_FIELDS,
    transition_keys_only: bool = False,
    issue_keys_only: bool = False,
    one_copy: bool = False,
) -> Relations:
    """Plan the selected relations.

    Parents are planned where a child needs them, and nothing else: boards
    only for boards, issues and transitions, issue bodies only for the last
    two. An invalid parent takes its children with it, because children join
    valid parents. ``stage`` may write a frame that several relations read.
    ``seen(project_id, entity_id)`` names issues an earlier batch has emitted.
    ``ready`` has checked projects and boards of an earlier build, which are then
    not built again. A caller that reads transitions of some tracked fields alone
    names them in ``transition_fields``, one that reads nothing but their keys and
    the reasons of rejects sets ``transition_keys_only``: other columns are then null.
    The rest of the histories moves in no shuffle. One that reads of issues only ids, keys,
    projects, times and rejects sets ``issue_keys_only``; their other columns are null then and not parsed.
    ``one_copy`` keeps an issue once in a project, too, where a board is there twice and plans are staged.
    """
    _need_utc((raw.projects if raw.issues is None else raw.issues).sparkSession)
    chosen = params.data_types(data_types)
    keys = params.name_list(project_keys)
    start, end = params.day("start_date", start_date), params.day("end_date", end_date)
    custom = params.custom_fields(custom_fields)
    wanted = set(chosen)
    checked: dict[str, DataFrame] = {}
    if ready:
        checked["projects"], checked["boards"] = ready["projects"], ready["boards"]
    elif wanted:
        selected = projects_by_key(raw.projects, keys)
        checked["projects"] = stage(check_projects(selected, raw.details), "projects")
    if "releases" in wanted:
        checked["releases"] = check_releases(_valid(checked["projects"]))
    if wanted & {"boards", "issues", "transitions"} and not ready:
        checked["boards"] = stage(check_boards(raw.boards, _valid(checked["projects"])), "boards")
    if wanted & {"issues", "transitions"}:
        issues = check_issues(
            raw.issues,
            _valid(checked["boards"]),
            start,
            end,
            custom,
            details="issues" in wanted and not issue_keys_only,
            histories="transitions" in wanted,
            stage=stage,
            history_fields=[name for name in TRACKED_FIELDS if name in set(transition_fields)],
            history_keys_only=transition_keys_only,
            one_copy=one_copy,
        )
        checked["issues"] = issues
        if seen is not None:
            fresh = without_present(checked["issues"], seen, ["project_id", "entity_id"])
            checked["issues"] = stage(fresh, "fresh_issues")
    if "transitions" in wanted:
        checked["transitions"] = check_transitions(_valid(checked["issues"]), transition_keys_only)
    return Relations(chosen, checked, raw.torn)


def _need_utc(spark: SparkSession) -> None:
    """Release dates and date ranges carry no offset and mean UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone!r}")


def _valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull())


def summary(relations: Mapping[str, DataFrame] | Relations) -> DataFrame:
    """Rows per relation, sorted by name. A relation without rows has no line."""
    parts = [df.select(F.lit(name).alias("data_type")) for name, df in relations.items()]
    if not parts:
        raise ValueError(f"no relation selected; valid ones are {sorted(DATA_TYPES)}")
    counts = reduce(DataFrame.unionByName, parts).groupBy("data_type")
    return counts.agg(F.count("*").alias("records")).orderBy("data_type")
