"""Keyword gates, categories, event codes and the other rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions.keywords import groups_found
from railtide.functions.labels import lookup
from railtide.functions.text import contains_any, fold

DEFAULT_GROUPS = {
    "academic": vocab.CLASS_SUSPENSION + vocab.ACADEMIC_CALENDAR + vocab.ACADEMIC_EXTRA,
    "lgu": (
        vocab.LGU_ADVISORY + vocab.CLASS_SUSPENSION + vocab.TRANSPORT_DISRUPTION
        + vocab.TRAIN_DEGRADATION + vocab.ARENA_EVENT + vocab.LGU_EXTRA
    ),
    "always_lgu": vocab.TRAFFIC + vocab.TRANSPORT_DISRUPTION + vocab.TRAIN_DEGRADATION + vocab.ARENA_EVENT,
    "context": vocab.ACADEMIC_CONTEXT,
}


def folded(text: Column) -> Column:
    """The form every keyword test works on."""
    return fold(F.coalesce(text, F.lit("")))


def gate_category(text: Column, groups: dict[str, Sequence[str]] = DEFAULT_GROUPS, mode: str = "substring") -> Column:
    """``academic``, ``lgu`` or NULL for folded text.

    Traffic, transport, train and arena words win; then academic words that have a school
    context; then words of local government as long as no academic word occurs.
    """
    has = groups_found(text, groups, mode)
    return (
        F.when(has["always_lgu"], F.lit("lgu"))
        .when(has["academic"] & has["context"], F.lit("academic"))
        .when(~has["academic"] & has["lgu"], F.lit("lgu"))
    )


def is_relevant(text: Column, mode: str = "substring", strong=vocab.RELEVANT_STRONG,
                titles=vocab.CALENDAR_TITLES, actions=vocab.CALENDAR_TITLE_ACTIONS,
                pattern=vocab.SUSPENSION_PATTERN,
                context=vocab.SUSPENSION_CONTEXT + vocab.RELEVANT_GENERAL) -> Column:
    """Announcement filter on folded text; a bare calendar title vetoes."""
    has = groups_found(text, {"titles": titles, "actions": actions, "strong": strong, "context": context}, mode)
    title_only = has["titles"] & ~has["actions"]
    return ~title_only & (has["strong"] | (has["context"] & text.rlike(pattern)))


def calendar_flags(text: Column, primary=vocab.CALENDAR_PRIMARY, timeframe=vocab.CALENDAR_TIMEFRAME,
                   action=vocab.CALENDAR_ACTION, structure=vocab.CALENDAR_STRUCTURE,
                   negative=vocab.CALENDAR_NEGATIVE) -> dict[str, Column]:
    return groups_found(text, {
        "primary": primary, "timeframe": timeframe, "action": action, "structure": structure, "negative": negative,
    })


def is_calendar_release(text: Column, **lists) -> Column:
    """Title and year, an action or a link, and nothing that says draft."""
    has = calendar_flags(text, **lists)
    return has["primary"] & has["timeframe"] & (has["action"] | has["structure"]) & ~has["negative"]


def has_calendar_hint(text: Column, **lists) -> Column:
    has = calendar_flags(text, **lists)
    return has["primary"] | has["timeframe"]


def concerns_branch(text: Column, target: str = vocab.BRANCH_TARGET,
                    systemwide: Sequence[str] = tuple(vocab.BRANCH_SYSTEMWIDE),
                    exception: str = vocab.BRANCH_EXCEPTION) -> Column:
    """Notice for all branches that does not except the target, or one that names it."""
    return F.when(contains_any(text, systemwide), ~text.rlike(exception)).otherwise(text.contains(target))


def source_category(name: Column, source_type: Column) -> Column:
    """Category of a source: its declared type, else by name, else academic."""
    low = F.lower(name)
    return (
        F.when(source_type.isin("academic", "lgu"), source_type)
        .when(low.contains("pagasa"), F.lit("pagasa"))
        .when(contains_any(low, vocab.ACADEMIC_NAMES), F.lit("academic"))
        .when(contains_any(low, vocab.LGU_NAMES), F.lit("lgu"))
        .otherwise(F.lit("academic"))
    )


def final_category(classified: Column, failed: Column, gate: Column, name: Column, source_type: Column) -> Column:
    """NULL if the classifier rejects; the keyword gate decides where it failed to answer."""
    return (
        F.when(classified.isNull() & ~F.coalesce(failed, F.lit(False)), F.lit(None).cast("string"))
        .when(classified.isNull(), gate)
        .when(classified == "academic_calendar", classified)
        .otherwise(source_category(name, source_type))
    )


def null_words(text: Column) -> Column:
    """Words that mean nothing was found become NULL."""
    return F.when(~F.lower(text).isin(*vocab.NULL_WORDS), text)


def allowed_category(text: Column, allowed: Sequence[str] = tuple(vocab.CATEGORIES)) -> Column:
    return F.when(text.isin(*allowed), text)


def category_label(category: Column) -> Column:
    plain = F.concat(F.upper(F.substring(category, 1, 1)), F.lower(F.substring(category, 2, 1_000_000)))
    return (
        F.when(category.isNull() | (category == ""), F.lit("N/A"))
        .otherwise(lookup(F.lower(category), vocab.CATEGORY_LABELS, plain))
    )


def category_code(category: Column) -> Column:
    return lookup(F.lower(category), vocab.CATEGORY_CODES, F.lower(category))


def rainfall_level(mm: Column) -> Column:
    """Level by millimetres; NULL rain has no level, dry is the word None."""
    return (
        F.when(mm > vocab.RAIN_RED_ABOVE, F.lit("Red"))
        .when(mm >= vocab.RAIN_ORANGE_FROM, F.lit("Orange"))
        .when(mm >= vocab.RAIN_YELLOW_FROM, F.lit("Yellow"))
        .when(mm.isNotNull(), F.lit("None"))
    )


def code_groups(rules=vocab.EVENT_CODE_RULES) -> dict[str, Sequence[str]]:
    """Keyword groups of the rules: the words of each code and its vetoes."""
    words = {f"{code}+{rank}": include for code, include, _, rank in rules}
    return words | {f"{code}-{rank}": exclude for code, _, exclude, rank in rules if exclude}


def event_code(text: Column | None, rules=vocab.EVENT_CODE_RULES, found: Mapping[str, Column] | None = None) -> Column:
    """Code of the first rule, by priority, whose words occur and whose vetoes do not.

    ``found`` are the groups of ``code_groups`` where they have been looked up already.
    """
    found = found or groups_found(text, code_groups(rules))
    out = F.lit(None).cast("string")
    for code, _, exclude, rank in sorted(rules, key=lambda r: r[3], reverse=True):
        hit = found[f"{code}+{rank}"]
        if exclude:
            hit = hit & ~found[f"{code}-{rank}"]
        out = F.when(hit, F.lit(code)).otherwise(out)
    return out


def cancel_groups(words=vocab.CANCEL_WORDS, lift_words=vocab.SUSPENSION_LIFT_WORDS) -> dict[str, Sequence[str]]:
    return {"cancel": words, "lift": lift_words}


def is_cancellation(text: Column | None, code: Column, words=vocab.CANCEL_WORDS,
                    lift_words=vocab.SUSPENSION_LIFT_WORDS, found: Mapping[str, Column] | None = None) -> Column:
    """True when something is lifted or called off; a new suspension is not a cancellation.

    Of a suspension only ``lift_words`` count: cancelled classes are the suspension itself.
    """
    found = found or groups_found(text, cancel_groups(words, lift_words))
    said = F.when(code.isin(*vocab.SUSPENDING_CODES), found["lift"]).otherwise(found["cancel"])
    return code.isNotNull() & ~code.isin(*vocab.NEVER_CANCELS) & said


def cancellation_target(code: Column, cancels: Column) -> Column:
    return F.when(cancels, lookup(code, vocab.CANCEL_TARGETS, code))


def affects_ridership(text: Column | None, code: Column, words=vocab.NON_DISRUPTIVE_WORDS,
                      found: Mapping[str, Column] | None = None) -> Column:
    found = found or groups_found(text, {"quiet": words})
    return code.isNotNull() & ~found["quiet"]


def repaired_category(source_name: Column, event_name: Column) -> Column:
    name, event = F.lower(F.coalesce(source_name, F.lit(""))), F.lower(F.coalesce(event_name, F.lit("")))
    return (
        F.when(contains_any(event, vocab.REPAIR_TRAFFIC), F.lit("lgu"))
        .when(name.contains("pagasa"), F.lit("pagasa"))
        .when(contains_any(name, vocab.REPAIR_LGU_NAMES), F.lit("lgu"))
        .otherwise(F.lit("acad"))
    )


def repair_flags(event_name: Column, code: Column) -> tuple[Column, Column]:
    """(code after repair, whether a cancellation mark must go)."""
    event = F.lower(F.coalesce(event_name, F.lit("")))
    traffic = contains_any(event, vocab.REPAIR_TRAFFIC)
    fixed = F.when(traffic, F.lit(vocab.REPAIR_TRAFFIC_CODE)).otherwise(code)
    false_mark = code.isin(*vocab.REPAIR_FALSE_CANCEL_CODES) & ~contains_any(event, vocab.REPAIR_LIFT_WORDS)
    return fixed, traffic | F.coalesce(false_mark, F.lit(False))


def id_number(text: Column, default: int = vocab.REPAIR_DEFAULT_NUMBER) -> Column:
    """Trailing number of ``a_b_12`` or ``a-b-12``; ids of fewer than three parts get the default."""
    def tail(mark: str) -> Column:
        parts = F.split(text, mark)
        last = F.element_at(parts, -1)
        return F.when((F.size(parts) >= 3) & last.rlike(r"^\d+$"), last.try_cast("bigint"))

    return F.coalesce(tail("_"), tail("-"), F.lit(default).cast("bigint"))
