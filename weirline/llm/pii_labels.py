"""Lines from which the labelled table of personal data is made. <kind:...> is personal data, # any digit.

The lines were written by hand; what isn't marked is nobody's data, however much it looks like it.
"""

from __future__ import annotations

import re

import numpy as np

LINES = """
call me at <phone:(###) ###-####> after six
phone: <phone:###-###-####>
tel. <phone:0## #######> or by post
Telefon <phone:0##/#######> täglich ab neun
téléphone : <phone:0# ## ## ## ##> le matin
teléfono <phone:9## ### ###> por la tarde
mobile <phone:0### ### ####>, office <phone:0## #### ####>
fax <phone:(0##) ### ##-##>
her number is <phone:###.###.####>
reach us on <phone:+## ## #### ####> any day
contact <phone:(###)###-####> or <email:reader##@example.org>
please ring <phone:###-####> for the desk
ask Ms Keller, <phone:030 #######>
hotline <phone:0800 ######> free of charge
dial <phone:###-###-####> for help
the number is <phone:###-###-####>, ask for Tom
his cell is <phone:###-###-####>
you may call <phone:###.###.####> or come by
call <phone:###-###-####> at once
cell <phone:###.###.####>
Praxis <phone:0###/######>, Herr Braun
Zentrale <phone:0##/#####>
privat <phone:0##/#######>, abends
office: <phone:###-###-####>
phone <phone:###-###-####>
mail <email:anna.b@example.com> today
write to <email:first_last@mail.example.net>, thanks
email=<email:user##@example.co.uk>
<email:info@example.org> | <phone:###-###-####> | open daily
the server at <ip:##.1#.#.2##> answered
from <ip:192.168.#.1##> port 443
client <ip:10.#.#.1#>: connected
card <card:luhn16> expires 11/26
paid with <card:luhn4444> yesterday
Karte <card:luhn16>, gültig bis 2027
on 12-11-#### we met again
am 03.04.#### in Wien
le ##-0#-#### à Paris
dated 1#/0#/#### and signed
invoice ###-###-#### of the month
Rechnung Nr. ###-###-#### liegt bei
order no. ###-###-#### was shipped
facture ##-##-##-## du mois
ticket ###-#### is closed
case ###.###.#### was dismissed
part number ###-###-####, see the list
article (###) ###-#### of the catalogue
ISBN 978-#-###-#####-#
ISBN #-###-#####-#
account balance: ####.## on 0#.0#.####
version 1.##.#.### was released
release 2.#.##.# fixes it
section 4.#.#.# of the law
Kapitel 3.#.1.# im Anhang
build 10.0.#####.### installed
at 10:##:## the train left
between 08:## and 17:## daily
pages ###-### of volume ##
the years 19##-20## were good
temperature -##.# to ##.# degrees
coordinates 52.#####, 13.#####
population ### ### ### in 20##
1 ### ### ### euros were paid
number ################ is not a card
serial ####-####-####-####
tracking ## #### #### #### ####
id=########## token=################
@reader## said so, see #####
#### @ 5 dollars each
score ###-### after ## rounds
room 0##-### on floor #
bus ### to stop ####-##
ref. ###/######/##
scaled by 0.### and ###.####
lot ###-##-#### of the auction
""".strip().split("\n")

SLOT = re.compile(r"<(email|ip|card|phone):([^>]*)>")


def _luhn(rng, size: int) -> str:
    digits = [int(x) for x in rng.integers(0, 10, size - 1)]
    total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
    return "".join(map(str, [*digits, -total % 10]))


def lines(templates: list[str] = LINES, times: int = 2, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Each line with digits filled in ``times`` times, and its spans (kind, start, end)."""
    rng, out = np.random.default_rng(seed), []
    for template in templates * times:
        text, spans, at = "", [], 0
        for m in SLOT.finditer(template):
            text += template[at : m.start()]
            value = m[2]
            if value.startswith("luhn"):
                card = _luhn(rng, 16)
                value = card if value == "luhn16" else " ".join(card[k : k + 4] for k in range(0, 16, 4))
            spans.append((m[1], len(text), len(text) + len(value)))
            text, at = text + value, m.end()
        text += template[at:]
        out.append(("".join(str(rng.integers(1, 10)) if c == "#" else c for c in text), spans))
    return out


def labelled(rows: list[tuple[str, list[tuple[str, int, int]]]], kinds: tuple[str, ...]) -> list[tuple[list[str], list[int]]]:
    """(words, labels): a word has the label of the span that it begins or lies in, 0 without one."""
    out = []
    for text, spans in rows:
        words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        labels = [next((kinds.index(k) + 1 for k, a, b in spans if x < b and a < y), 0) for _, x, y in words]
        out.append(([w for w, _, _ in words], labels))
    return out
