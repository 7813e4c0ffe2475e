"""The reports: each takes (sources, params) and returns a DataFrame."""

from monthclose.plans.accounts import (
    applications,
    bankruptcy,
    charge_off,
    collections,
    id_theft,
    mla,
    scra,
)
from monthclose.plans.complaints import complaints_tier1, complaints_tier2
from monthclose.plans.contacts import call_kpis, calls, disputes, fraud_cases, sla
from monthclose.plans.correspondence import correspondence, opt_outs
from monthclose.plans.portfolio import portfolio
from monthclose.plans.transactions import credit_refunds, transactions

REPORTS = {
    "id_theft": id_theft,
    "sla": sla,
    "applications": applications,
    "bankruptcy": bankruptcy,
    "disputes": disputes,
    "calls": calls,
    "charge_off": charge_off,
    "collections": collections,
    "complaints_tier1": complaints_tier1,
    "complaints_tier2": complaints_tier2,
    "credit_refunds": credit_refunds,
    "portfolio": portfolio,
    "correspondence": correspondence,
    "fraud_cases": fraud_cases,
    "call_kpis": call_kpis,
    "mla": mla,
    "opt_outs": opt_outs,
    "scra": scra,
    "transactions": transactions,
}
