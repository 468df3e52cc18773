"""Op 2 on labelled tokens in styles that its own generators don't make."""

import base64
import random

from quillmesh.llm import secrets

NOUNS = "quarter ledger invoice harbour window gradient tensor socket payload customer voucher meadow turbine lantern ballast orchard pipeline cluster snapshot registry migration fixture retry backoff".split()
GERMAN = "donaudampfschifffahrt rechtsschutzversicherung bundesausbildungsgesetz kraftfahrzeughaftpflicht arbeiterunfallversicherung lebensmittelgeschaeft".split()


def ordinary(rng):
    """Constants, slugs, versions, paths, class names, long words, dated file names, dotted keys with numbers."""
    a, b, c, d = (rng.choice(NOUNS) for _ in range(4))
    return [
        f"{a}_{b}_{c}".upper(),
        f"{a}-{b}-{c}-{rng.randrange(1, 30)}",
        f"{a}-{b}-v{rng.randrange(9)}-{rng.randrange(20)}-{rng.randrange(20)}",
        f"/usr/share/{a}/{b}/{c}",
        f"{a.title()}{b.title()}{c.title()}Factory",
        rng.choice(GERMAN) + rng.choice(["", "en", "s"]),
        f"{a}_{b}_2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}",
        f"{a}{b.title()}{c.title()}{d.title()}",
    ]


def random_ones(rng):
    """Base 64, base 62, URL-safe and upper-case keys, base 32, mixed with marks."""
    raw = rng.randbytes(24)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    return [
        base64.b64encode(raw).decode(),
        base64.urlsafe_b64encode(raw).decode().rstrip("="),
        pick(upper + upper.lower() + digits, 32),
        pick(upper + digits, 28),
        base64.b32encode(raw[:20]).decode(),
        "sk-" + pick(upper + upper.lower() + digits, 40),
        pick(upper.lower() + digits, 30),
        "x_" + pick(upper + upper.lower() + digits + "_-", 36),
    ]


def test_rates_on_other_styles(make, sample):
    """Among ordinary prose, which gives the ordinary samples."""
    rng = random.Random(11)
    plain, keys = ([t for _ in range(25) for t in f(rng)] for f in (ordinary, random_ones))
    rows = [(i, f"see {t} there") for i, t in enumerate([*plain, *keys])]
    prose = [(1000 + i, t) for i, t in sample[1].items()]
    got = {r.doc_id: r.n_model + r.n_hex for r in secrets.find_secrets(make([*rows, *prose])).collect()}
    false = sum(got[i] > 0 for i in range(len(plain))) / len(plain)
    found = sum(got[i] > 0 for i in range(len(plain), len(rows))) / len(keys)
    print(f"false alarms {false:.3f} of {len(plain)}, found {found:.3f} of {len(keys)}")
    assert false <= 0.05 and found >= 0.9
