"""Links with the source that takes them, none where no source does."""

LINK_CASES = [
    ("https://www.biospace.com/news/a", "BioSpace"), ("https://www.biospace.com/news/career-advice/a", None), ("https://biospace.com/about", None),
    ("https://www.biospectrumasia.com/news/1", "BioSpectrum"), ("https://www.biospectrumasia.com/2024/05/x", "BioSpectrum"), ("https://www.biospectrumasia.com/x", None),
    ("https://www.bioworld.com/articles/123-x", "BioWorld"), ("https://www.bioworld.com/articles/topic/9", None), ("https://www.bioworld.com/articles/1-x?v=preview", None),
    ("https://www.businessweekly.co.uk/any", "Business Weekly"), ("https://www.businesswire.com/news/home/1", "Business Wire"), ("https://www.businesswire.com/rss/news/1", None),
    ("https://cen.acs.org/pharma/articles/1", "C&EN"), ("https://cen.acs.org/content/cen/news/1", "C&EN"), ("https://cen.acs.org/about/articles", None),
    ("https://www.europeanpharmaceuticalreview.com/article/1", "European Pharmaceutical Review"), ("https://www.europeanpharmaceuticalreview.com/news/1", None),
    ("https://www.fda.gov/news-events/1", "FDA"), ("https://www.fiercebiotech.com/biotech/x", "Fierce Biotech"), ("https://www.fiercebiotech.com/tag/biotech/", None), ("https://www.fiercebiotech.com/x", None),
    ("https://www.fiercepharma.com/x", "Fierce Pharma"), ("https://www.genengnews.com/topics/x", "GEN"), ("https://www.genengnews.com/page/2/", None), ("https://www.mdpi.com/1-2/3", "MDPI"),
    ("https://www.nature.com/nbt/articles/1", "Nature Biotechnology"), ("https://www.nature.com/nbt/v1/n2/x", "Nature Biotechnology"), ("https://www.nature.com/articles/1", None),
    ("https://www.pharmaceutical-technology.com/features/x", "Pharmaceutical Technology"), ("https://www.pharmaceutical-technology.com/2024/05/x", None),
    ("https://www.thepharmaletter.com/insights/x", "The Pharma Letter"), ("https://www.thepharmaletter.com/news/search", None), ("https://pharmaphorum.com/opinion/x", "Pharmaphorum"), ("https://pharmaphorum.com/2024/05/x", None),
    ("https://pharmatimes.com/2024/05/x", "PharmaTimes"), ("https://www.pharmavoice.com/news/x", "PharmaVoice"), ("https://www.pharmavoice.com/x", None), ("https://pmlive.com/pharma_news/x", "PMLive"), ("https://pmlive.com/2024/05/x", None),
    ("https://www.prnewswire.com/news-releases/health-x", "PR Newswire"), ("https://www.prnewswire.com/news-releases/cars-x", None), ("https://www.statnews.com/2024/05/06/x", "STAT News"), ("https://www.statnews.com/x", None),
    ("https://www.the-scientist.com/x", "The Scientist"), ("https://endpoints.news/x", "Endpoints News"), ("https://www.biopharmadive.com/news/x", "BioPharma Dive"), ("https://example.com/news/x", None), ("https://notbiospace.com/news/x", None),
]
