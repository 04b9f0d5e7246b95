"""Lines from which labelled findings are made. {s:form} is a secret, {n:form} a string that looks like one and isn't.

The lines were written by hand after what configuration, code, logs and prose look like, not after what
the forest measures. Each is filled in several times from hashes.
"""

from __future__ import annotations

import base64
import hashlib
import re

LINES = """
token = "{s:hex40}"
a reader of the log will find "{s:hex40}" behind access_token: twice
auth_token: '{s:hex32}'
export AWS_SECRET_ACCESS_KEY={s:b64_40}
aws_access_key_id = {s:akia}
aws_secret_access_key = {s:b64_40}
{"api_key":"{s:hex40}","region":"europe-west-central"}
{"user": "reader", "password": "{s:mixed20}", "database": "customer_accounts_main"}
Authorization: Bearer {s:b64_64}
Authorization: Bearer {s:jwt}
curl -H "X-Api-Key: {s:hex32}" https://api.example.org/v2/measurements/latest
curl -u deploy:{s:mixed24} https://repository.example.org/artifacts/upload
https://storage.example.com/bucket/reports/2023/summary?access_token={s:hex40}
git clone https://builder:{s:gh}@code.example.com/team/project-templates.git
GITHUB_TOKEN={s:gh}
stripe.api_key = "{s:sk}"
SLACK_BOT_TOKEN=xoxb-{s:digits12}-{n:digits12}-{s:mixed24}
jdbc:postgresql://db.example.com:5432/warehouse?user=etl&password={s:mixed20}
<password>{s:mixed20}</password>
client = Client("{s:hex32}", timeout=30)
secret: {s:b64_44}
my api key is {s:mixed32} please do not share it
login with password {s:mixed20} and then change it
DB_PASSWORD="{s:mixed24}"
private_key_id: {s:hex40}
"client_secret": "{s:mixed32}",
consumerSecret={s:mixed44}
set credentials.secretKey={s:b64_40} in the service settings
webhook secret is {s:hex64}
sessionToken: "{s:b64_64}"
encryption.key={s:b64_44}
x = "{s:hex40}"
here is the key: {s:sk}
the old one ({s:hex32}) was revoked, access by {s:mixed32} now
commit {n:hex40} fixes the parser
merge {n:hex40} into release-candidate-branch
sha256: {n:hex64}
checksum {n:hex64} warehouse-export-2023-11-02.tar.gz
md5sum {n:hex32} photograph-collection.zip
"integrity": "sha512-{n:b64_88}"
image: registry.example.org/services/ingest@sha256:{n:hex64}
ETag: "{n:hex32}"
request id {n:uuid} finished after 35 ms
trace {n:uuid} span {n:hex16}
uuid: {n:uuid}
revision = "{n:hex40}"
digest={n:hex64}
index {n:hex40}..{n:hex40} 100644
<img src="data:image/png;base64,{n:b64_64}">
token = "YOUR_ACCESS_TOKEN_GOES_HERE"
password = "change-this-password-now"
api_key = "<insert-your-api-key-here>"
secret_key_base: example_secret_key_for_tests
access_token = get_access_token_from_environment(configuration)
password_reset_confirmation_email_template = load(name)
public static final String DEFAULT_PASSWORD_PROPERTY = "authentication.password.default";
from com.example.security.authentication.TokenProvider import create_token_provider
/usr/local/share/documentation/authentication/tokens/index.html
/home/reader/projects/measurements/src/main/resources/application.properties
C:/Windows/System32/drivers/etc/hosts.backup.original
https://www.example.org/articles/2021/05/how-to-store-passwords-safely
see https://docs.example.com/reference/authentication/access-tokens#refresh
at org.example.pipeline.stages.ValidationStage.processElement(ValidationStage.java:118)
class AbstractSingletonProxyFactoryBeanConfiguration extends BaseConfiguration
def test_returns_an_error_when_the_token_has_expired(self):
the internationalisationandlocalisation of the counterrevolutionaries
Donaudampfschifffahrtsgesellschaft und Rechtsschutzversicherungsgesellschaften
anticonstitutionnellement, electroencefalografistas
thequickbrownfoxjumpsoverthelazydog thisisonlyatestofthehashtag
never.again.without.mentioning.the.source and/or/neither/nor/either
SUPERCALIFRAGILISTIC kindergartenbetreuungsgutschein
phone 0049-30-1234567890123456 and account 1234567890123456789
order 20231102-000000123456789 shipped
version 1.2.3-beta.20231102.123456789
--------------------------------------------
________________________________________
....................................
==== ++++++++++++++++++++++++ ====
| ------------------ | ------------------ |
.navigation-menu__item--highlighted-and-active
background-image-position-horizontal-center
2023-11-02T10:15:30.123456789Z/2023-11-03T10:15:30.123456789Z
mail1234.reader.of.the.list@lists.example.org
abcdefghijklmnopqrstuvwxyz0123456789
ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz
xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx
0000000000000000000000000000000000000000
aaaabbbbccccddddeeeeffff00001111
{"measurement_identifier":"{n:uuid}","temperature_in_celsius":21.5}
GET /static/assets/bundles/application-{n:hex20}.js 200
node_modules/.cache/babel-loader/{n:hex64}.json
latitude=52.5200065999999&longitude=13.404953999999
Content-Type: application/x-www-form-urlencoded;charset=utf-8
Licensed-under-the-Apache-License/Version-2.0/http://www.apache.org/licenses/LICENSE-2.0
password: {s:word14}
password = "{s:sign12}"
pw={s:sign20}
pwd={s:word10};
"db_password": "{s:sign14}",
user: reader, pass: {s:word12}
mysql -u root --password={s:sign12} inventory
PGPASSWORD='{s:sign16}' psql -h db.example.org
login: admin password: {s:word10}
passphrase: {s:sign24}
<add key="AdminPassword" value="{s:sign14}" />
redis://:{s:sign16}@cache.example.net:6379/0
ftp://backup:{s:word12}@files.example.com/incoming
Authorization: Bearer {s:sign32}
Authorization: Basic {s:b64_28}
https://hooks.example.com/services/T{n:digits8}/B{n:digits8}/{s:mixed24}
https://chat.example.net/api/webhooks/{n:digits18}/{s:mixed60}
key={s:hex32}
smtp_pass = {s:word12}
PIN code: {s:digits8} for the safe
secret: {s:sign12}
wifi password is: {s:word12}
root_password: !vault {s:hex40}
passwd={s:sign10}&remember=1
password: required, at least {n:digits2} characters
password = os.environ["DB_PASSWORD"]
password: ********
password=<hidden>
password: string
token: null
token: undefined,
secret = input("secret: ")
pass: see the wiki
user: administrator
name: "Wilhelmine"
title: Introduction
status=completed
Note: nothing was changed.
version: 12.4.1
date=2023-11-02
time: 10:15:30
color: #a1b2c3
size=1024x768
path=/var/log/messages
charset=utf-8
level=warning
Subject: minutes of yesterday's meeting
width: 100%;
ratio: 16:9
price: $1,299.00
phone: +49-30-1234567
mail: reader@example.org
author: O'Brien & Sons
he said: "Nevertheless!"
Warning: deprecated!
isbn: 978-3-16-148410-0
id={n:digits8}
count: {n:digits10}
session={n:uuid}
build={n:hex8}
Bearer of good news
Basic knowledge helps
""".strip().split("\n")

#: What people make passwords of, and the signs in them.
CHOSEN = ("summer", "hunter", "dragon", "monkey", "football", "welcome", "secret", "orange", "winter", "charlie", "letmein", "master", "shadow", "sunshine", "tiger")
SIGNS = "!@#$%^&*+?~"
SLOT = re.compile(r"\{([sn]):(\w+)\}")


def filled(form: str, key: str) -> str:
    """A string of a form, drawn from the hash of a key."""
    raw = hashlib.sha512(key.encode()).digest() + hashlib.sha512(f"{key} more".encode()).digest()
    text = base64.b64encode(raw).decode()
    plain = re.sub("[^A-Za-z0-9]", "", text)
    name, size = re.fullmatch(r"([a-z]+)(?:64_)?(\d*)", form).groups()
    n = int(size or 0)
    if name == "hex":
        return raw.hex()[:n]
    if name == "b":
        return text[:n] if n % 4 or n > 80 else base64.b64encode(raw[: n // 4 * 3 - 1]).decode()
    if name == "mixed":
        return plain[:n]
    if name == "digits":
        return str(int.from_bytes(raw[:16], "big"))[:n]
    if name == "word":  # a word or two, digits and perhaps a sign, as people choose them
        pick = int.from_bytes(raw[:8], "big")
        words = [CHOSEN[pick % len(CHOSEN)], CHOSEN[pick // 97 % len(CHOSEN)]]
        out = words[0].capitalize() if pick & 1 else words[0]
        out += str(pick // 7 % 10000) + ("!" if pick & 2 else "") + words[1]
        return out[:n] if len(out) >= n else out + plain[: n - len(out)]
    if name == "sign":  # letters, digits and signs
        letters = [SIGNS[b % len(SIGNS)] if b % 5 == 0 else plain[k % len(plain)] for k, b in enumerate(raw)]
        return "".join(letters)[:n]
    if name == "uuid":
        h = raw.hex()
        return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:32]))
    if name == "akia":
        return "AKIA" + base64.b32encode(raw).decode()[:16]
    if name == "gh":
        return f"ghp_{plain[:36]}"
    if name == "sk":
        return f"sk_live_{plain[:24]}"
    if name == "jwt":
        return f"eyJ{plain[:33]}.eyJ{plain[33:90]}.{plain[90:133]}"
    raise ValueError(f"no form {form!r}")


def lines(templates: list[str] = LINES, times: int = 20, seed: str = "train") -> list[tuple[str, list[str]]]:
    """Each line filled ``times`` times, with its secrets."""
    out = []
    for t, template in enumerate(templates):
        for k in range(times):
            secrets: list[str] = []

            def put(m, t=t, k=k, secrets=secrets):
                value = filled(m[2], f"{seed} {t} {k} {m.start()}")
                if m[1] == "s":
                    secrets.append(value)
                return value

            out.append((SLOT.sub(put, template), secrets))
    return out
