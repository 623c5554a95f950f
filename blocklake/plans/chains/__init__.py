"""Chain models: what each family's tables, requests, relations and fields are. Data alone; see query.py for what reads it."""

from __future__ import annotations

from blocklake.plans.chains import evm, fuel, solana, starknet, substrate, tron
from blocklake.plans.specs import Model

MODELS: dict[str, Model] = {m.name: m for m in (evm.MODEL, solana.MODEL, substrate.MODEL, tron.MODEL, starknet.MODEL, fuel.MODEL)}
