"""The semantics once more in plain Python, one loan at a time, for comparison."""

from datetime import timedelta


def business_days(loan):
    cd, closing = loan["cd"], loan["closing_date"]
    if cd["issue_date"] is None or closing is None:
        return None
    lo, hi = cd["issue_date"] - timedelta(days=10), closing + timedelta(days=10)
    holidays = loan["calendar"]["holidays"]
    if holidays is None:
        return []
    days = [lo + timedelta(days=n) for n in range((hi - lo).days + 1)]
    return [d for d in days if d.isoweekday() != 7 and d not in holidays]


def receipt(loan):
    cd, days = loan["cd"], business_days(loan)
    if cd["delivery_method"] == "in_person":
        return cd["received_date"]
    if days is None or cd["mailed_date"] is None:
        return None
    later = [d for d in days if d > cd["mailed_date"]]
    return later[2] if len(later) > 2 else None


def verdicts(loan):
    """{(paragraph letter): result} of the rules that fire."""
    days, got, closing = business_days(loan), receipt(loan), loan["closing_date"]
    timeshare = loan["transaction"]["timeshare"]
    out = {}
    if timeshare is False and days is not None:
        n = 0 if got is None else sum(got <= d < closing for d in days)
        out["A"] = "pass" if n >= 3 else "fail"
    if timeshare is True and got is not None and closing is not None:
        out["B"] = "pass" if got <= closing else "fail"
    return out
