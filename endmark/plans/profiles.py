"""Library protocols: what `auto` stands for in each, and the evidence sources that compete."""

from __future__ import annotations

# For each protocol what auto resolves to.
DEFAULTS = {
    "plasmidsaurus_3prime": {"layout": "SE", "strandedness": "forward", "evidence_source": "read_3p", "endpoint_model": "proximal_tag"},
    "exact_boundary": {"layout": "auto", "strandedness": "auto", "evidence_source": "auto", "endpoint_model": "exact_boundary"},
    "generic_3prime": {"layout": "auto", "strandedness": "auto", "evidence_source": "auto", "endpoint_model": "auto"},
}
# Fixed value: the span in which the plasmidsaurus_3prime protocol's reads end.
TERMINAL_SPAN = {"plasmidsaurus_3prime": 400}
# The sources in order for single reads (SE) and, where they differ, pairs (PE).
SOURCES = {
    ("plasmidsaurus_3prime", "SE"): ("read_3p",),
    ("exact_boundary", "SE"): ("polyA_junction", "read_3p"),
    ("exact_boundary", "PE"): ("polyA_junction", "fragment_3p", "read_3p"),
    ("generic_3prime", "SE"): ("read_3p", "read_5p", "polyA_junction"),
    ("generic_3prime", "PE"): ("read_3p", "read_5p", "fragment_3p", "polyA_junction"),
}


def _known(profile: str) -> str:
    if profile not in DEFAULTS:
        raise ValueError(f"unknown library profile {profile}; known: {', '.join(sorted(DEFAULTS))}")
    return profile


def resolved(profile: str, **given: str) -> dict[str, str]:
    """The protocol's settings, with every one that is given and not auto in place of the default."""
    defaults = DEFAULTS[_known(profile)]
    if unknown := sorted(set(given) - set(defaults)):
        raise ValueError(f"no settings of a protocol: {', '.join(unknown)}")
    return {"library_profile": profile} | {k: d if given.get(k, "auto") == "auto" else given[k] for k, d in defaults.items()}


def sources(profile: str, layout: str) -> tuple[str, ...]:
    """The candidate sources of a layout. An undecided layout counts as pairs for exact_boundary alone."""
    _known(profile)
    pairs = layout == "PE" or (profile == "exact_boundary" and layout != "SE")
    return SOURCES.get((profile, "PE"), SOURCES[profile, "SE"]) if pairs else SOURCES[profile, "SE"]
