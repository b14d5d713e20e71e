"""Word lists, tables and patterns that results depend on."""

# Fixed values, in their natural order. ---------------------------------------------

CONFUSIONS = (
    ("DUEX", "DUKE"), ("rn", "m"), ("cl", "d"), ("vv", "w"), ("aud", "and"), ("aad", "and"), ("tiie", "the"), ("tlie", "the"),
    ("bnt", "but"), ("iu", "in"), ("thau", "than"), ("cau", "can"), ("wheu", "when"), ("theu", "then"), ("rnost", "most"),
    ("raay", "may"), ("couutry", "country"), ("ou", "on"), ("LOEDS", "LORDS"), ("COUONS", "COMMONS"),
)

CONFUSION_PAIRS = (
    ("X", "K"), ("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("aud", "and"), ("aad", "and"), ("cau", "can"),
    ("iu", "in"), ("thau", "than"), ("bnt", "but"), ("tiie", "the"), ("tlie", "the"),
)

PRESERVED_SPELLINGS = (
    "connexion", "shew", "shewn", "shewed", "pro formâ", "portale", "favourable", "colour", "honour", "labour", "favour",
    "endeavour", "neighbour", "centre", "theatre", "metre", "travelled", "marvellous", "acknowledgement", "judgement",
)

PARLIAMENTARY_TERMS = (
    "HOUSE", "LORDS", "COMMONS", "MAJESTY", "LORDSHIPS", "DUKE", "EARL", "LORD", "BARON", "VISCOUNT", "BILL", "ACT", "PARLIAMENT",
    "SESSION", "RESOLUTION", "COMMITTEE", "THRONE", "SPEAKER", "ADDRESS", "FEBRUARY", "MARCH", "APRIL", "JANUARY", "DECEMBER",
)

WHITELIST = (
    "connexion", "connexions", "shew", "shewed", "shewn", "compleat", "compleated", "chuse", "chusing",
    "Freeling", "Frome", "Dacre", "Bourne", "Tanworth", "Willington", "Arle", "Carleton", "Brough", "Tennant", "Maryborough",
    "Swanton", "Campion", "Mold", "Buxton",
)

MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)

LATIN_MONTHS = (
    "JANUARII", "FEBRUARII", "MARTII", "APRILIS", "MAII", "JUNII", "JULII", "AUGUSTI", "SEPTEMBRIS", "OCTOBRIS", "NOVEMBRIS", "DECEMBRIS",
)

NON_SPEAKERS = (
    "THE NOBLE DUKE", "THE NOBLE LORD", "THE NOBLE MARQUESS", "THE HONOURABLE MEMBER", "THE HONOURABLE GENTLEMAN",
    "THE HONOURABLE BARONET", "THE RIGHT HONOURABLE GENTLEMAN", "THE RIGHT HONOURABLE BARONET", "THE SIREXISTS STATED",
    "THE BILL BEFORE THE HOUSE",
)

#: Characters that may follow the month of a date header.
DATE_CHARACTERS = "0123456789.,;:°*' —IilVXLCDM"

# Fixed patterns. -------------------------------------------------------------------

ENTITY = r"^(?:The |LORD |EARL |DUKE |Mr\. |Sir |COLONEL |MAJOR |CAPTAIN )?[A-Z][A-Za-z\s\-]+\.—"

DATE_HEADER = rf"(?i)^(?:{'|'.join(MONTHS)})\s+[{DATE_CHARACTERS}]+$"

FOOTER = r"\n\s*No\.\s+[IVXLCDM\d]+\.?—[A-Za-z]+\.\s*1834\.\s*\n*\s*$"

HEADER_AND_REST = r"^(?:[^\S\n]*\n)*([^\n]*\S[^\n]*)\n[^\S\n]*(?:\n(?:[^\S\n]*\n)*(?:[^\S\n]*\z)?|\z)(.*)$"

BARE_HOUSE = r"(?i)^\s*HOUSE OF (COMMONS|LORDS)\.?\s*$"

SPEAKER_START = (
    r"(?:Mr|MR|H.|Mrs|MRS|Miss|MISS|Sir|SIR|Dr|DR)\.?\s+[A-Z][^\n—]*?"
    r"|(?:LORD|Lord|EARL|Earl|VISCOUNT|Viscount|DUKE|Duke|MARQUESS|Marquess)\s+[A-Z][^\n—]*?"
    r"|The\s+[A-Z][A-Za-z]+[^\n—]*?"
    r"|(?:Several|SEVERAL|Many|MANY|An|AN|A|a)\s+[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*\s+Members?(?:\s+together)?\.?"
)

DASH_LABEL = (
    r"^((?:Mr|MR|Mrs|MRS|Miss|MISS|Ms|MS|Dr|DR|Sir|SIR|Lord|LORD|Lady|LADY|Colonel|COLONEL|Major|MAJOR|Captain|CAPTAIN"
    r"|Viscount|VISCOUNT|Earl|EARL|Duke|DUKE|Marquess|MARQUESS|The\s+LORD\s+CHANCELLOR|The\s+CHANCELLOR\s+of\s+the\s+EXCHEQUER"
    r"|The\s+ATTORNEY\s+GENERAL|The\s+SOLICITOR\s+GENERAL|An?\s+HONOURABLE\s+MEMBER(?:\s+for\s+[A-Z][A-Za-z'\-]+)?"
    r"|Several\s+Honourable\s+Members|Several\s+Irish\s+Members\s+together|Many\s+Honourable\s+Members|[A-Z][A-Z\s\.'-]+))\s*[–—\-]\s"
)

VERB_TITLES = (
    r"Mr|MR|Mrs|MRS|Miss|MISS|Ms|MS|Dr|DR|Sir|SIR|Lord|LORD|Lady|LADY|Colonel|COLONEL|Major|MAJOR|Captain|CAPTAIN"
    r"|Viscount|VISCOUNT|Earl|EARL|Duke|DUKE|Marquess|MARQUESS|The\s+MARQUESS\s+of\s+[A-Z][A-Za-z'-]+|The\s+EARL\s+of\s+[A-Z][A-Za-z'-]+"
    r"|The\s+DUKE\s+of\s+[A-Z][A-Za-z'-]+|The\s+LORD\s+CHANCELLOR|The\s+CHANCELLOR\s+of\s+the\s+EXCHEQUER"
)
FURTHER_NAME = r"\s+[A-Z][A-Za-z\.'-]+"
VERBS = r"presented|brought\s+up|brought\s+in|gave\s+notice|then\s+gave\s+notice|moved|rose\s+to\s+move"
VERB_LABEL = rf"(?i)^((?:{VERB_TITLES})(?:{FURTHER_NAME})*)\s+(?:{VERBS})\b"

NAME_LABEL = (
    r"^((?:Mr|MR|Mrs|MRS|Miss|MISS|Ms|MS|Dr|DR|Sir|SIR|Lord|LORD|Lady|LADY|Colonel|COLONEL|Major|MAJOR|Captain|CAPTAIN)\.?\s+[A-Z][A-Za-z\.'-]+)"
)

HEADING_OF_BODY = (
    r"^(?:(?:(?:Mr|MR|Mrs|MRS|Ms|MISS|Sir|SIR|Dr|DR|Lord|LORD|Earl|EARL|Viscount|VISCOUNT|Marquess|MARQUESS|Duke|DUKE"
    r"|Colonel|COLONEL|Captain|CAPTAIN|Major|MAJOR)\.?(?:\s+[A-Z][A-Za-z\.'-]+)*)"
    r"|(?:The\s+(?:(?:Lord|LORD|Earl|EARL|Viscount|VISCOUNT|Marquess|MARQUESS|Duke|DUKE|Bishop|BISHOP|Archbishop|ARCHBISHOP"
    r"|Chancellor|CHANCELLOR|Speaker|SPEAKER)(?:\s+of\s+[A-Z][A-Za-z\.'-]+)*))"
    r"|(?:(?:An|AN|A|SEVERAL|Several)\s+(?:HONOURABLE|Honourable)\s+Members?(?:\s+together)?))\s*[—\-]\s*"
)
