"""The contracts as the bound tables need them: 64-bit keys."""

from __future__ import annotations

from orestrata.plans.contracts import CONTRACTS, wide_keys

BOUND = wide_keys(CONTRACTS)
