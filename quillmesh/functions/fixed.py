"""Patterns, word lists and tables that results depend on."""

# Sentence patterns of short boilerplate, in order.
SHORT_BOILERPLATE = [
    r"to read the rest of this story subscribe to[^.]*\.",
    r"to read the full (article|story)[^.]*subscribe[^.]*\.",
    r"to read the full (article|story)[^.]*sign (up|in)[^.]*\.",
    r"subscribe to[^.]*stat\+[^.]*\.",
    r"subscribe to[^.]*stat[^.]*\.",
    r"subscribe to[^.]*premium[^.]*\.",
    r"sign up for[^.]*newsletter[^.]*\.",
    r"subscribe to[^.]*newsletter[^.]*\.",
    r"to submit a correction request[^.]*\.",
    r"to submit a correction[^.]*\.",
    r"for more information[^.]*\.",
    r"read more at[^.]*\.",
]

# Markers after which a text ends, in order.
SHORT_MARKERS = [
    r"\.\s*to read the rest.*$",
    r"\.\s*to read the full.*$",
    r"\.\s*subscribe.*$",
    r"\.\s*to submit a correction.*$",
    r"\.\s*contact us.*$",
    r"\.\s*for more information.*$",
]

# Sentence patterns of the long boilerplate list, in order.
LONG_BOILERPLATE = [
    r"to read the rest of this story subscribe to[^.]*\.",
    r"to read the full (article|story)[^.]*subscribe[^.]*\.",
    r"to read the full (article|story)[^.]*sign (up|in)[^.]*\.",
    r"to read the full article sign up for free or sign in\.",
    r"to read the full story subscribe or sign in\.",
    r"subscribe to[^.]*stat\+[^.]*\.",
    r"subscribe to[^.]*stat[^.]*\.",
    r"subscribe to[^.]*premium[^.]*\.",
    r"subscribe now[^.]*\.",
    r"sign up for[^.]*premium[^.]*\.",
    r"get daily news updates[^!.]*[!.]",
    r"get weekly news updates[^!.]*[!.]",
    r"when you subscribe to genepool[^!.]*[!.]",
    r"subscribe to genepool[^!.]*[!.]",
    r"join genepool[^!.]*[!.]",
    r"sign up for genepool[^!.]*[!.]",
    r"get the latest news[^!.]*subscribe[^!.]*[!.]",
    r"stay updated[^!.]*subscribe[^!.]*[!.]",
    r"never miss[^!.]*subscribe[^!.]*[!.]",
    r"don't miss[^!.]*subscribe[^!.]*[!.]",
    r"to submit a correction request[^.]*\.",
    r"to submit a correction[^.]*\.",
    r"correction request[^.]*contact us[^.]*\.",
    r"please visit our contact us page\.",
    r"visit our contact us page\.",
    r"contact us[^.]*correction[^.]*\.",
    r"sign up for[^.]*newsletter[^.]*\.",
    r"subscribe to[^.]*newsletter[^.]*\.",
    r"get[^.]*newsletter[^.]*\.",
    r"receive[^.]*newsletter[^.]*\.",
    r"get free access to[^.]*articles[^.]*newsletters[^.]*\.",
    r"choose newsletters to get straight to your inbox\.",
    r"sign up to receive[^!.]*[!.]",
    r"subscribe to receive[^!.]*[!.]",
    r"follow us on[^.]*\.",
    r"like us on facebook[^.]*\.",
    r"connect with us on[^.]*\.",
    r"join us on[^.]*linkedin[^.]*\.",
    r"[a-z]+ [a-z]+ covers[^.]*\.\s*(to read|subscribe|to submit)",
    r"[a-z]+ [a-z]+ contributes to[^.]*\.\s*(to read|subscribe|to submit)",
    r"for more information[^.]*\.",
    r"read more at[^.]*\.",
    r"click here[^!.]*[!.]",
    r"please click here[^!.]*[!.]",
    r"learn more[^.]*\.",
    r"continue reading[^.]*\.",
    r"start your free trial[^!.]*[!.]",
    r"try it free[^!.]*[!.]",
    r"register now[^!.]*[!.]",
    r"register for free[^!.]*[!.]",
    r"create your free account[^!.]*[!.]",
    r"signin or subscribe[^!.]*[!.]",
    r"login or subscribe[^!.]*[!.]",
    r"please login or subscribe[^!.]*[!.]",
    r"subscribe now for[^!.]*[!.]",
    r"for instant access[^!.]*[!.]",
    r"\d+ word remain[^!.]*[!.]?",
]

# Markers of the long list, in order.
LONG_MARKERS = [
    r"\.?\s*to read the rest.*$",
    r"\.?\s*to read the full.*$",
    r"\.?\s*to continue reading.*$",
    r"\.?\s*subscribe now.*$",
    r"\.?\s*signin or subscribe.*$",
    r"\.?\s*login or subscribe.*$",
    r"\.?\s*please login or subscribe.*$",
    r"\.?\s*to submit a correction.*$",
    r"\.?\s*click here to.*$",
    r"\.?\s*click here for.*$",
    r"\.?\s*and it'?s all free.*$",
    r"\.?\s*subscribe today.*$",
    r"\.?\s*login here.*$",
    r"\.?\s*for more information and to place your order.*$",
    r"\.?\s*\d+ word remain.*$",
]

# Markers removed after lemmatising, in order.
LATE_MARKERS = [
    r"click here.*$",
    r"to register click here.*$",
    r"signin or subscribe.*$",
    r"login or subscribe.*$",
    r"please login or subscribe.*$",
    r"subscribe now.*$",
    r"for instant access.*$",
    r"\d+ word remain.*$",
    r"register now.*$",
    r"subscribe today.*$",
]

# Affixes that text exports leave behind, in order.
EXPORT_AFFIXES = [r"^jatsp", r"jatsp$", r"^jats", r"jats$", r"^abstract\b", r"^doi\b", r"^pmid\b"]

# 2-digit source codes by lower-cased name.
SOURCE_CODES = {
    "gen": "01", "biospace": "02", "biopharmadive": "03", "biopharma dive": "03", "bioworld": "04", "cen": "05", "c&en news": "05", "endpointsnews": "06",
    "europeanpharmaceuticalreview": "07", "european pharmaceutical review": "07", "fiercebiotech": "08", "fierce biotech": "08", "fiercepharma": "09", "fierce pharma": "09",
    "mdpi": "10", "naturebiotech": "11", "nature biotechnology": "11", "pharmavoice": "12", "pharma voice": "12", "pharmaceuticaltech": "13", "pharmaceutical technology": "13",
    "pharmatimes": "14", "pharma times": "14", "pharmaphorum": "15", "pmlive": "16", "pm live": "16", "prnewswire": "17", "pr newswire": "17", "statnews": "18", "stat news": "18",
    "thescientist": "19", "the scientist": "19", "fda": "20", "businesswire": "21", "business wire": "21", "businessweekly": "22", "business weekly": "22", "biospectrum": "23", "pharmaletter": "24",
}

# Source types by substring, first match wins; otherwise Other.
SOURCE_TYPES = [
    ("News", ["news", "times", "post", "journal", "report"]),
    ("Government", ["fda", "ema", "who", "nih", "gov"]),
    ("Academic", ["university", "college", "institute"]),
    ("Industry", ["biotech", "pharma", "medical", "health"]),
]

# Substrings that make an entity an Organization.
ORGANIZATION_MARKS = ["fda", "ema", "who", "nih", "university", "college", "institute", "hospital"]

# Tag categories by substring with their domain, first match wins; otherwise Other/General.
TAG_CATEGORIES = [
    ("Event", "Business", ["acquisition", "merger", "partnership", "collaboration", "licensing", "buyout", "takeover", "biotech deal", "pharma deal", "m&a", "alliance", "option agreement", "co-development", "in-license", "out-license", "funding", "financing", "investment", "raises", "series a", "series b", "series c", "venture capital", "ipo", "private placement", "oversubscribed", "seed funding", "crossover round", "pipe", "dilutive financing", "non-dilutive funding", "led by", "participated", "syndicate", "biotech funding"]),
    ("Clinical", "Healthcare", ["clinical stage", "phase 2", "phase 3", "fda approval"]),
    ("Manufacturing", "Operations", ["in-house manufacturing", "contract manufacturing", "capacity shortage", "manufacturing", "contract"]),
    ("Therapy", "Healthcare", ["oncology", "cancer", "tumor", "immunotherapy", "car-t", "adc"]),
    ("Entity", "Healthcare", ["preclinical", "clinical-stage", "platform company", "therapeutic"]),
]

# Keyword variations by exact tag name.
VARIATIONS = {
    "acquisition": ["acquire", "acquired", "acquires", "buy", "purchase", "purchased"],
    "merger": ["merge", "merged", "merges", "combine", "combined"],
    "partnership": ["partner", "partnered", "partners", "alliance", "collaborate"],
    "collaboration": ["collaborate", "collaborated", "collaborates", "cooperation"],
    "licensing": ["license", "licensed", "licenses", "licence", "licenced"],
    "buyout": ["buy out", "bought out"],
    "takeover": ["take over", "took over"],
    "m&a  (mergers & acquisitions)": ["m&a", "mergers and acquisitions", "ma", "mna"],
    "alliance": ["strategic alliance", "partnership"],
    "option agreement": ["option", "option deal"],
    "co-development": ["co development", "joint development"],
    "in-license": ["in license", "in-licensing"],
    "out-license": ["out license", "out-licensing"],
    "clinical stage": ["clinical", "clinical-stage"],
    "phase 2": ["phase ii", "phase-2"],
    "phase 3": ["phase iii", "phase-3"],
    "fda approval": ["fda", "approved", "approval"],
    "funding": ["fund", "funded", "funds", "capital"],
    "financing": ["finance", "financed"],
    "investment": ["invest", "invested", "investor"],
    "raises": ["raise", "raised", "raising"],
    "venture capital": ["vc", "venture", "venture capitalist"],
    "ipo": ["initial public offering", "public offering", "go public"],
    "private placement": ["private", "placement"],
    "round": ["funding round", "investment round"],
    "capital raise": ["raise capital", "capital raising"],
    "oversubscribed": ["over-subscribed", "over subscribed"],
    "seed funding": ["seed", "seed round"],
    "crossover round": ["crossover"],
    "pipe": ["private investment in public equity"],
    "led by": ["lead investor", "leading"],
    "participated": ["participant", "participating"],
    "syndicate": ["syndicated", "syndication"],
    "biotech funding": ["biotech investment", "biotech capital"],
    "preclinical": ["pre-clinical"],
    "clinical-stage": ["clinical stage"],
    "platform company": ["platform"],
    "therapeutic": ["therapy"],
}
# Variations by substring of the tag name, used where no exact name of an earlier rule matches.
DEAL_VARIATIONS = ["agreement", "transaction", "contract"]
DILUTIVE_VARIATIONS = ["dilutive financing", "non-dilutive financing"]

# Words that end a company name, dropped when names are compared.
COMPANY_SUFFIXES = ["inc", "incorporated", "corp", "corporation", "ltd", "limited", "llc", "llp", "co", "company", "group", "holdings", "labs", "laboratories", "therapeutics", "pharma", "biotech", "biosciences", "biopharmaceuticals", "pharmaceuticals", "biotechnology", "technologies", "solutions", "systems", "international", "global", "ag", "sa", "nv", "plc", "gmbh", "kk", "ltda", "srl", "spa", "sas"]

# Substrings that no company name holds.
NOT_COMPANY = ["alzheimer", "oncology", "neurology", "immunology", "hematology", "diabetes", "cancer", "therapeutic", "drug", "treatment", "therapy", "patient", "clinical", "trial", "approval", "fda", "ema", "regulatory", "disease", "disorder", "syndrome", "condition", "biomarker"]

# Endings dropped for the bridge lookup, first match wins.
BRIDGE_SUFFIXES = [" inc", " inc.", " incorporated", " corp", " corp.", " corporation", " ltd", " ltd.", " limited", " llc", " company", " co", " co.", " pharmaceuticals", " pharma", " biotech", " biotechnology", " therapeutics", " biosciences"]

# Optional words after a mention.
MENTION_SUFFIXES = ["inc", "incorporated", "corp", "corporation", "ltd", "limited", "llc", "pharmaceuticals", "pharma", "biotech", "biotechnology", "therapeutics", "biosciences"]

# End patterns dropped in turn when a registry name is normalised, and when one is cleaned for display.
REGISTRY_PATTERNS = [
    r"\s+(inc\.?|corp\.?|corporation|company|co\.?|ltd\.?|llc|plc|lp|llp)$",
    r"\s+(holdings?|group|international|intl\.?|enterprises?)$",
    r"\s+(pharmaceuticals?|therapeutics?|biosciences?|biotech)$",
    r",\s*inc\.?$",
]
DISPLAY_PATTERNS = [r"\s+(Inc\.?|Corp\.?|Ltd\.?|LLC|PLC|Co\.?|Company|Corporation|Limited)$", r"\s+(Holdings?|Group|International|Intl\.?)$"]

# Industry valences that overlay a sentiment lexicon.
VALENCES = {
    "breakthrough": 4.0, "innovative": 2.5, "approved": 3.5, "approval": 3.0, "cleared": 2.5, "clearance": 2.0, "fast-track": 2.5, "blockbuster": 3.0, "efficacy": 2.5, "efficacious": 2.5, "effective": 2.0, "outperform": 2.0, "potency": 1.5,
    "acquisition": 2.0, "merger": 1.5, "collaboration": 2.0, "partnership": 2.0, "growth": 2.0, "milestone": 2.5,
    "failed": -4.0, "failure": -3.5, "rejected": -3.0, "rejection": -3.0, "denied": -2.5, "disappointing": -2.5, "setback": -2.5, "delay": -2.0, "halted": -3.0, "suspended": -3.0, "terminated": -3.0, "discontinued": -2.5,
    "recall": -3.5, "toxicity": -3.0, "toxic": -3.0, "adverse": -2.5, "unfavorable": -2.5, "lawsuit": -2.5, "litigation": -2.0, "violation": -2.5, "sanction": -2.5, "patent-cliff": -2.5,
    "layoff": -2.0, "reduction": -1.5, "shortfall": -2.0, "decline": -2.0, "underperform": -2.0,
}

#: substrings that mark a medical text
MEDICAL_TERMS = ["cancer", "therapy", "treatment", "drug", "clinical"]

# Tag names that mean a therapy take the general keywords.
THERAPY_TERMS = ["therapy", "cancer", "oncology", "tumor", "immunotherapy", "car-t", "adc"]

# Phrases that mark a page behind a paywall, anywhere in its text.
PAYWALL = [
    "subscribe",
    "subscription",
    "premium",
    "sign in to continue",
    "log in to read",
    "unlock this article",
    "become a member",
    "already a subscriber",
    "free articles remaining",
    "you have reached your",
    "limited free articles",
]

# Marketing sentences and first words of paragraphs that are not article text.
MARKETING = [
    r"Get free access to a limited number of articles, plus choose newsletters to get straight to your inbox\.",
    "Unlock this article by subscribing",
]
NAVIGATION = ["menu", "navigation", "share", "follow", "subscribe", "read more", "click here", "home", "about", "contact"]

# Topic keywords of two sources.
HEALTH_TOPICS = [
    "pharma", "pharmaceutical", "drug", "biotech", "biotechnology", "fda", "clinical trial", "medicine", "therapeutic", "treatment",
    "healthcare", "medical device", "biologics", "vaccine",
]

# How each source's article links are told from other links, by
# name, host, parts that all must occur, parts and patterns of which one must occur
# (if there are none, every link of the host counts), parts that must not occur,
# least body length, fixed author.
_DATED = r"/\d{4}/\d{2}/"
SOURCES = [
    ("BioPharma Dive", "biopharmadive.com", [], [], [], [], 0, ""),
    ("BioSpace", "biospace.com", [], ["/news/", "/drug-development/", "/policy/", "/business/", "/fda/", "/press-releases/"], [],
     ["/career-advice/", "/job-trends/", "/hiring-outlook/", "/salary/", "/compensation/", "/layoff-tracker/", "/hotbeds/", "/venture-capital/",
      "/real-estate/", "/conference/", "/webinar/", "/event/"], 50, ""),
    ("BioSpectrum", "biospectrumasia.com", [], ["/news/", "/article/"], [_DATED], [], 100, ""),
    ("BioWorld", "bioworld.com", [], [], [r"/articles/\d+-"], ["/topic/", "?v=preview"], 100, ""),
    ("Business Weekly", "businessweekly.co.uk", [], [], [], [], 100, ""),
    ("Business Wire", "businesswire.com", ["/news/"], [], [], ["/rss", "/feed"], 100, ""),
    ("C&EN", "cen.acs.org", [], [], [r"cen\.acs\.org/.*articles", r"cen\.acs\.org/content/cen/news"],
     ["/static/", "/about/", "/sitemap", "/static.html", "/sponsored-content/"], 100, ""),
    ("Endpoints News", "endpoints.news", [], [], [], [], 100, ""),
    ("European Pharmaceutical Review", "europeanpharmaceuticalreview.com", ["/article/"], [], [], [], 100, ""),
    ("FDA", "fda.gov", [], [], [], [], 100, "FDA"),
    ("Fierce Biotech", "fiercebiotech.com", [], ["/biotech/", "/research/", "/manufacturing/", "/regulatory/", "/deals/", "/people/"], [_DATED],
     ["/page/", "/category/", "/tag/", "/author/", "/feed", "/rss"], 100, ""),
    ("Fierce Pharma", "fiercepharma.com", [], [], [], [], 100, ""),
    ("GEN", "genengnews.com", [], [], [], ["/latest-posts/", "/page/"], 100, ""),
    ("MDPI", "mdpi.com", [], [], [], [], 0, ""),
    ("Nature Biotechnology", "nature.com", ["/nbt/"], ["/articles/"], [r"/nbt/v\d+/n\d+"], [], 100, ""),
    ("Pharmaceutical Technology", "pharmaceutical-technology.com", [], ["/news/", "/features/", "/analysis/"], [], [], 100, ""),
    ("The Pharma Letter", "thepharmaletter.com", [], ["/news/", "/article/", "/insights/", "/regulatory/", "/therapy-areas/"], [_DATED],
     ["/category/", "/tag/", "/author/", "/page/", "/search", "/login", "/subscribe"], 50, ""),
    ("Pharmaphorum", "pharmaphorum.com", [], ["/news/", "/article/", "/opinion/"], [], [], 100, ""),
    ("PharmaTimes", "pharmatimes.com", [], ["/news/", "/article/"], [_DATED], [], 200, ""),
    ("PharmaVoice", "pharmavoice.com", [], ["/news/", "/article/"], [_DATED], [], 100, ""),
    ("PMLive", "pmlive.com", [], ["/news/", "/article/", "/pharma_news/"], [], [], 100, ""),
    ("PR Newswire", "prnewswire.com", [], [], ["(?i)/news-releases/(health|biotech|pharma|medical|biotechnology|pharmaceutical)"], [], 100, ""),
    ("STAT News", "statnews.com", [], ["/news/", "/article/"], [_DATED], [], 100, ""),
    ("The Scientist", "the-scientist.com", [], [], [], [], 50, ""),
]

# fixed values: the published rule set of the valence lexicon: negations, boosters and dampers, idioms
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't "
    "isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont "
    "wouldnt won't wouldn't rarely seldom despite"
).split()
BOOSTERS = dict.fromkeys((
    "absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously "
    "flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin fugging greatly hella highly hugely incredible incredibly intensely major majorly more "
    "most particularly purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very"
).split(), 0.293) | dict.fromkeys((
    "almost,barely,hardly,just enough,kind of,kinda,kindof,kind-of,less,little,marginal,marginally,occasional,occasionally,partly,scarce,scarcely,slight,slightly,somewhat,sort of,sorta,sortof,sort-of"
).split(","), -0.293)
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9}

# fixed values: the published detachment rules (ending, replacement) by part of speech, in order
DETACHMENT = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
}

# fixed values: by source the elements that hold an article's text, the elements left out of them, and the length that a paragraph must exceed
_USUAL = ["nav", "footer", ".advertisement", ".ad", ".related-articles"]
_SHARED = [*_USUAL, ".social-share"]
_SIGNED = [*_SHARED, ".author-box"]
_PLAIN = [".article-content", ".entry-content", ".article-body", "article .content"]
BODIES = {
    "BioPharma Dive": ([], _SHARED, 40),
    "BioSpace": ([], _USUAL, 50),
    "BioSpectrum": ([*_PLAIN, ".story-content", ".news-content", "#article-content"], [*_SIGNED, ".tags", ".share-buttons"], 30),
    "BioWorld": ([], _SHARED, 40),
    "Business Weekly": ([*_PLAIN, "main .content"], _SIGNED, 30),
    "Business Wire": ([".bw-release-story", ".bw-release-text", ".bw-release-body", "article .content"], [*_SHARED, ".bw-release-contact"], 30),
    "C&EN": ([], _USUAL, 40),
    "Endpoints News": ([], _SHARED, 40),
    "European Pharmaceutical Review": ([], _SHARED, 40),
    "FDA": (['div[role="main"]', "article#main-content", ".field-body", ".article-body", "main .content"], [*_SHARED, ".breadcrumb", ".skip-link", ".inset-column"], 30),
    "Fierce Biotech": ([], [*_SHARED, ".byline", "header", ".article-header", ".tags", ".categories", ".subscribe", ".newsletter"], 40),
    "Fierce Pharma": ([], _SHARED, 40),
    "GEN": ([".td-post-content", ".entry-content", "article .td-post-content"], [*_SIGNED, ".td-post-sharing"], 40),
    "MDPI": ([], _USUAL, 40),
    "Nature Biotechnology": ([".c-article-body", '[data-test="article-body"]', ".article__body", "article .c-article-body"], [*_SIGNED, ".c-article-references"], 40),
    "Pharmaceutical Technology": (_PLAIN, _SIGNED, 40),
    "The Pharma Letter": ([], _USUAL, 40),
    "Pharmaphorum": ([".entry-content", ".article-content", ".post-content", "article .content"], _SIGNED, 40),
    "PharmaTimes": ([".et_pb_post_content", ".entry-content", ".et_pb_text_inner", ".article-content", "article .content"], [*_SIGNED, ".tags", ".meta"], 40),
    "PharmaVoice": (
        ["article .article-body", "article .content-body", ".article-body-content", ".post-content", ".entry-content", "article .entry-content", ".article-content"],
        ["nav", "footer", "header", *_SIGNED[2:], ".share-buttons", ".social-media", "button", ".button", ".menu", ".navigation", ".sidebar", "aside", ".newsletter", ".subscribe"],
        30,
    ),
    "PMLive": (_PLAIN, _SIGNED, 40),
    "PR Newswire": ([], _SHARED, 40),
    "STAT News": (_PLAIN, [*_SIGNED, ".paywall", ".subscription-required"], 40),
    "The Scientist": ([], [*_SHARED, "aside", ".paywall", ".subscription", ".premium"], 40),
}
