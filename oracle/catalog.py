"""All oracle SQL by query name."""

from oracle import changes, checks, fraud, marts, streams


def oracle_sql() -> dict[str, str]:
    return {
        **marts.oracles(),
        **fraud.oracles(),
        **checks.oracles(),
        **changes.oracles(),
        **streams.oracles(),
    }
