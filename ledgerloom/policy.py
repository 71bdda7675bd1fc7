"""Constants of the three rule sets.

``classic``, ``batch`` and ``pilot`` differ in what they accept; operators take
a ``policy`` and default to the strictest.
"""

from __future__ import annotations

import unicodedata

POLICIES = ("classic", "batch", "pilot")


def check(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {', '.join(POLICIES)}")
    return policy


# Mailbox names that stand for an office, not a person.
GENERIC = {
    "classic": ("info", "office", "sekretariat", "sekretariát", "kancelar", "kancelář", "skola", "škola"),
    "batch": ("info", "skola", "school", "office", "sekretariat", "sekretariát", "kancelar", "kancelář", "recepce", "kontakt", "mail", "email", "podatelna", "admin", "webmaster", "noreply", "no-reply", "support"),
    "pilot": ("info", "office", "skola", "school", "sekretariat", "kancelar", "podatelna"),
}

# Hosts of public mail services.
FREEMAIL = {
    "classic": ("gmail.com", "googlemail.com", "outlook.com", "hotmail.com", "live.com", "icloud.com", "me.com", "seznam.cz", "email.cz", "post.cz", "centrum.cz", "atlas.cz", "volny.cz"),
    "batch": ("gmail.com", "googlemail.com", "seznam.cz", "email.cz", "post.cz", "centrum.cz", "atlas.cz", "volny.cz", "outlook.com", "hotmail.com", "live.com", "icloud.com", "me.com", "yahoo.com", "yahoo.co.uk", "tiscali.cz", "quick.cz"),
}

# Weights of terms in a link's slug.
LINK_TERMS = (
    ("kontakt", 12), ("kontakty", 12), ("vedeni", 11), ("reditel", 10), ("reditelka", 10), ("zamestnanci", 10), ("zamestnanec", 9), ("pedagog", 9),
    ("pedagogicky-sbor", 12), ("sbor", 7), ("ucitele", 10), ("ucitel", 8), ("pracovnici", 8), ("o-skole", 5),
    ("aktuality", -7), ("novinky", -6), ("fotogalerie", -10), ("galerie", -8), ("jidel", -7), ("archiv", -6), ("soutez", -5), ("projekt", -3), ("dokument", -2), ("uredni-deska", -5),
)

# Patterns and weights of the batch link score.
LINK_PATTERNS = (
    ("kontakt|contact", 14),
    ("pedagog|staff|zamestnan|ucitel|teachers|sbor", 20),
    ("vedeni|leadership|reditel|pracovnic", 14),
    ("o.skole|about", 5),
    ("druzina|jidelna|poradensk", 5),
    ("aktualit|novink|archiv|foto|galerie|soutez|kalendar|202[0-5]", -14),
)
LINK_FILES = "[.](pdf|docx?|xlsx?|png|jpe?g|zip|mp4)$"
LINK_DENIED = "(?i)/(api|wp-admin|wp-json|admin|login|prihlaseni|intranet|__cms|studio)(?![A-Za-z0-9_])"
LEAST_SCORE = 4
PAGE_BUDGET = {"classic": 12, "batch": 22}

# Role patterns in their order, and the role each stands for. The
# classic forms match feminine nouns only, as they always did.
CLASSIC_ROLES = (
    ("ředitelka?", "ředitel/ředitelka"),
    ("zástup(?:ce|kyně)", "zástupce/zástupkyně"),
    ("ICT\\s+koordinátor", "ICT koordinátor/koordinátorka"),
    ("koordinátor(?:ka)?\\s+ICT", "ICT koordinátor/koordinátorka"),
    ("učitelka?", "učitel/učitelka"),
    ("pedagog", "pedagog"),
    ("sekretářka?", "sekretář/sekretářka"),
    ("ekonomka?", "ekonom/ekonomka"),
    ("hospodářka?", "hospodář/hospodářka"),
    ("výchovn(?:ý|á)\\s+porad(?:ce|kyně)", "výchovný poradce/poradkyně"),
    ("metodik(?:čka)?\\s+prevence", "metodik/metodička prevence"),
    ("školní\\s+psycholog", "školní psycholog/psycholožka"),
    ("asistent", "asistent/asistentka"),
)
BATCH_ROLES = "ředitel(?:ka)?|zástup(?:ce|kyně)|třídní učitel(?:ka)?|učitel(?:ka)?|vychovatel(?:ka)?|asistent(?:ka)? pedagoga|psycholog(?:ka|žka)?|speciální pedagog|sociální pedagog|koordinátor(?:ka)?|metodik(?:čka)?|ekonom(?:ka)?|hospodář(?:ka)?|vedoucí[^\\n]{0,45}|sekretář(?:ka)?"

# Words of blocks that belong to service firms, of pages that are not found, of controls that hide people.
SERVICE_WORDS = "Primirest|sídlo společnosti|webdesign|tvorba webových"
NOT_FOUND = "404|stránk[au].*(nenalez|nepodařilo)|page not found"
PROFILE_WORDS = "zobrazit profil|view profile|detail pracovníka"
STAFF_CONTROLS = "učitel|pedagog|vedení|zaměstn|asistent|vychovatel|1[.] stupeň|2[.] stupeň|kontakt|sbor|staff"
STAFF_PAGES = "pedagog|staff|zamestnan|ucitel|teachers|sbor|vedeni"
BROWSER_PATHS = "sbor|zamestnan|ucitele|vedeni|staff|teachers"
INVALID_RECORD = "Tento záznam školy není platný"
NEXT_WORDS = "další|následující|next|»|›"
STICKY_REASONS = "CONFLICT|CHANGED|SHARED|SUPPRESS"

# Address patterns and spelled-out signs.
CLASSIC_EMAIL = "[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,}"
BATCH_EMAIL = "[A-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Z0-9.-]+[.][A-Z]{2,}"
CLASSIC_HIDDEN = r"([A-Z0-9._%+-]+)\s*(?:\[at\]|\(at\)|\[zavinac\]|\(zavinac\)|zavinac)\s*([A-Z0-9.-]+)\s*(?:\[dot\]|\(dot\)|\[tecka\]|\(tecka\)|tecka)\s*([A-Z]{2,})"
BATCH_AT = r"\s*(?:\[\s*(?:at|zavin[aá]č)\s*\]|\(\s*(?:at|zavin[aá]č)\s*\))\s*"
BATCH_DOT = r"\s*(?:\[\s*(?:dot|tečka)\s*\]|\(\s*(?:dot|tečka)\s*\))\s*"
PILOT_AT = r"\s*(?:\[at\]|\(at\)|\[zavináč\]|\(zavináč\)|\[zavinac\]|\(zavinac\))\s*"
PILOT_DOT = r"\s*(?:\[dot\]|\(dot\)|\[tečka\]|\(tečka\)|\[tecka\]|\(tecka\))\s*"

# Letters of names and limits of the pairing.
UPPER = "A-ZÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ"
LOWER = "a-záčďéěíňóřšťúůýž"
CONTEXT_CHARS, CONTEXT_LEVELS, NAME_REACH, BLOCK_CHARS = 1200, 8, 160, 950

# Academic titles before and after a name.
TITLES = "Mgr|Bc|Ing|PhDr|RNDr|JUDr|PaedDr|ThDr|MUDr|MVDr|doc|prof"
TITLES_BEFORE = "prof|doc|Mgr|MgA|Ing|BcA|Bc|PhDr|RNDr|JUDr|PaedDr|ThDr|MUDr|MVDr|DiS|Dis|M[.]A|Ph[.]D"
TITLES_AFTER = "Ing[.]?|Mgr[.]?|Bc[.]?|PhDr[.]?|RNDr[.]?|JUDr[.]?|MBA|Ph[.]?D[.]?|CSc[.]?|DiS[.]?|MSc[.]?|LLM|Dr[.]?|ak[.]?\\s*mal[.]?|ml[.]?|st[.]?"

# Words that are no part of a person's name.
NO_PERSON = ("Zakladni", "Základní", "Stredni", "Střední", "Skola", "Škola", "Kontakt", "Kontakty", "Vedeni", "Vedení", "Telefon", "Email", "E-mail", "Praha", "Reditel", "Ředitel", "Reditelka", "Ředitelka", "Zastupce", "Zástupce", "Ucitel", "Učitel", "Ucitelka", "Učitelka")
NO_SURNAME = ("skola", "ulice", "trida", "kontakt", "classroom", "online", "praha")
NAME_NOISE = ("google", "classroom", "microsoft", "facebook", "instagram", "kontakt", "kontakty", "škola", "school")

# Words that do not tell one organisation from another.
NAME_STOPWORDS = {
    "classic": ("zakladni", "skola", "stredni", "gymnazium", "praha", "mesto", "prispevkova", "organizace"),
    "batch": ("zakladni", "skola", "stredni", "gymnazium", "praha", "materska", "prispevkova", "organizace", "odborna", "vyssi", "skol", "soukroma"),
}

# Common given names. A fuller dictionary is a parameter of every function that splits names
# (and --given-names of the commands, a text file of one name a line): names it lacks are not taken for persons.
GIVEN_NAMES = tuple(
    (
        "Adam Adéla Agáta Alena Aleš Alexandr Alexandra Alice Alois Alžběta Andrea Aneta Anežka Anna Antonín Barbora Blanka Bohdan Bohumil Bohumila Bohumír Bohuslav Božena Břetislav "
        "Čestmír Dagmar Dalibor Dana Daniel Daniela David Denis Denisa Diana Dita Dominik Dominika Dušan Eduard Elena Eliška Ema Emil Emílie Erik Erika Ester Eva Evžen Ferdinand "
        "Filip František Františka Gabriel Gabriela Hana Hedvika Helena Hynek Ilona Irena Iva Ivan Ivana Iveta Ivo Jakub Jan Jana Jarmila Jaromír Jaroslav Jaroslava Jindřich Jindřiška "
        "Jiří Jiřina Jitka Johana Jolana Josef Josefa Julie Kamil Kamila Karel Karla Karolína Kateřina Klára Kristina Kristýna Květa Květoslava Ladislav Lada Lea Lenka Leoš Libor Libuše "
        "Linda Lubomír Lubomíra Lucie Luděk Ludmila Lukáš Lýdie Magdaléna Marcel Marcela Marek Marie Markéta Marta Martin Martina Matěj Matyáš Michael Michaela Michal Milada Milan "
        "Milena Miloš Miloslav Miloslava Miluše Miroslav Miroslava Monika Naďa Naděžda Natálie Nela Nikola Nina Oldřich Olga Oliver Ondřej Oskar Otakar Oto Patrik Pavel Pavla Pavlína "
        "Petr Petra Radek Radim Radka Radmila Radomír Radovan René Renata Richard Robert Roman Romana Rostislav Rudolf Růžena Sabina Samuel Sára Silvie Simona Soňa Stanislav "
        "Stanislava Šárka Šimon Štěpán Štěpánka Tereza Tomáš Václav Vendula Věra Veronika Viktor Viktorie Vilém Vít Vladimír Vladimíra Vlasta Vojtěch Zbyněk Zdeněk Zdeňka Zuzana Žaneta"
    ).split()
)


def _fold_table() -> tuple[str, str]:
    """Accented Latin letters that decompose to an ASCII letter, and those letters."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


FOLD_FROM, FOLD_TO = _fold_table()
