"""Fixed values of the domain: ordered rule lists, word lists, thresholds, formats.

Everything in this module is data.  Rule lists are ordered (first match wins) and
their patterns are applied to lower-cased text unless the comment says otherwise.
"""

# --------------------------------------------------------------------------
# Taxonomic domains
# --------------------------------------------------------------------------
FEATURE_DOMAINS = [
    ("Viruses", r"virus|viral|phage|virion|caudoviric|duplodnaviria|monodnaviria|varidnaviria|riboviria|uroviricota|anellovir|votu|microviridae"),
    ("Archaea", r"\barchae"),
    ("Bacteria", r"bacteri|cyanobacteri|proteobacteri|firmicut|bacteroidot|actinobacteri"),
    ("Fungi", r"\bfungi|fungal|ascomycot|basidiomycot|mucoromycot|chytridiomycot|yeast"),
    ("Eukaryota", r"eukaryot|eukarya|metazoa|viridiplantae|protist|chromista|alveolata|stramenopil|rhizaria|apicomplexa|opisthokonta"),
]
DOMAIN_LABELS = ["Bacteria", "Archaea", "Viruses", "Fungi", "Eukaryota", "Unclassified"]

PAPER_DOMAINS = [
    ("Viruses", r"\bvotu\b|viral genome|viral cluster|viral family|viral taxon|viral operational|viral scaffold|virome|phage genome|phage .{0,14}cluster|\bvmag\b|anellovir"),
    ("Fungi", r"\bits[12]\b|\bits[-_ ]?(region|amplicon|gene|rrna|rdna|sequencing|primer)\b|internal transcribed spacer|fungal|\bfungi\b|yeast"),
    ("Eukaryota", r"\b18s\b|protist|eukaryot"),
    ("Bacteria", r"16s|\botu|\basv|rrna|metaphlan|kraken|bracken|motu|\bsgb\b|\bmag\b|genus|species|phylum|family|bacteri|rpob|cpn60|nifh"),
]
# noun stem -> kind; bacteria and archaea together count as one kind
DOMAIN_NOUN_KINDS = [
    ("bacteri", "prokaryote"), ("archae", "prokaryote"), ("fung", "fungus"),
    ("virus", "virus"), ("viral", "virus"), ("eukaryot", "eukaryote"), ("protist", "eukaryote"),
]
PAPER_NEGATED_DOMAIN = r"\bno[nt]?-?\s*(viral|virus|viruses|fungal|fungi|bacteria|archaea)\b"
CELL_NEGATED_DOMAIN = r"\bno[nt]?-?\s*(viral|virus|viruses|fungal|fungi|bacterial|bacteria|archaeal|archaea|eukaryotic|eukaryota)\b"
UNKNOWN_DOMAIN_WORDS = ["unassigned", "unclassified", "unknown", "none", "na", "norank"]
UNKNOWN_TAXON_WORDS = ["unassigned", "unclassified", "unknown", "norank", "uncultured", "na", "none", "other", "others"]
KEPT_APART_CLAUSE = r"kept (as |separately|out)|retained separately|kept in alternative|alternative_versions|as an? alternative|not merged|kept apart"

# --------------------------------------------------------------------------
# Assay, unit and row rank
# --------------------------------------------------------------------------
ASSAYS = [
    ("Viral metagenomics (virome)", r"\bvotu|virome|viral metagenom|vlp\b|viral genome|vmag"),
    ("Metatranscriptomics", r"metatranscript|rna-seq|metatranscriptom|total rna"),
    ("Metaproteomics", r"metaproteom|spectral|metaprotein"),
    ("qPCR / targeted panel", r"qpcr|upip|taqman|digital pcr|ddpcr"),
    ("Shotgun metagenomics", r"shotgun|metagenom|metaphlan|kraken|bracken|humann|motus|\bmag\b|\bsgb\b|uhgg|gtdb|kaiju"),
    ("ITS amplicon (fungi)", r"\bits[12]\b|\bits[-_ ]?(region|amplicon|gene|rrna|rdna|sequencing|primer)\b|internal transcribed spacer"),
    ("18S rRNA amplicon", r"\b18s\b"),
    ("Other marker gene", r"cpn60|nifh|rpob|\bcoi\b|amoa"),
    ("16S rRNA amplicon", r"16s|\bv3-v4\b|\bv4\b|\bv1-v2\b|\bv3v4\b|amplicon|\basv\b|\botu\b"),
]
UNITS = [
    ("Relative abundance (proportion / percent)", r"relative abundance|relative frequency|proportion|percent|%|fraction|tss|share of reads|compositional"),
    ("Read count (rarefied / equal depth)", r"rarefi|subsampl|equal depth|resampl|even depth"),
    ("Coverage / RPKM / normalised", r"rpkm|fpkm|\bcpm\b|\btpm|coverage|normalis|normaliz|mean depth|log10|spectral abundance|magnitude"),
    ("Read count (raw / filtered)", r"count|reads|read-pair|read pair"),
]
NORMALISATION_TERM = r"rarefi\w*|rarif\w*|normali[sz]\w*|subsampl\w*|filtered|thresholded|scaled"
ROW_RANKS = [
    ("vOTU / viral genome", r"\bvotu|viral genome|viral cluster|viral scaffold|phage genome|vmag"),
    ("MAG / genome bin", r"\bmag\b|genome bin|genome cluster|metagenome-assembled|representative genome|\bsgb\b|\bmsp\b|\bosu\b|uhgg"),
    ("ASV / exact sequence variant", r"\basv\b|exact .*sequence|sequence variant|zotu|\bsv\b"),
    ("OTU", r"\botu\b|operational taxonomic"),
    ("Species", r"species"),
    ("Strain / isolate", r"strain|isolate|reference cluster"),
    ("Genus", r"genus|genera"),
    ("Family", r"family|families"),
    ("Order", r"\border\b"),
    ("Class", r"\bclass\b"),
    ("Phylum", r"phylum|phyla|division"),
    ("Kingdom / Domain", r"kingdom|domain|superkingdom"),
]
# coarse to fine, the order rank tables are printed in
ROW_RANK_ORDER = [
    "Kingdom / Domain", "Phylum", "Class", "Order", "Family", "Genus", "Species", "Strain / isolate",
    "OTU", "ASV / exact sequence variant", "vOTU / viral genome", "MAG / genome bin", "Other / mixed",
]
LINEAGE_RANKS = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]
RANK_LETTERS = {"d": "kingdom", "k": "kingdom", "p": "phylum", "c": "class", "o": "order", "f": "family", "g": "genus", "s": "species"}
# viral names state their rank through a suffix; listed in the order they are tried
VIRAL_SUFFIX_RANKS = [
    ("viricetes", "class"), ("viricota", "phylum"), ("virales", "order"), ("viridae", "family"),
    ("virinae", "family"), ("virae", "kingdom"), ("viria", "kingdom"),
]

# --------------------------------------------------------------------------
# Sample type, host, environment
# --------------------------------------------------------------------------
SAMPLE_TYPES = [
    ("Gut / stool", r"stool|feces|faec|fecal|\bgut\b|caecal|cecal|colon|intestin|rumen|rectal|digesta|midgut|hindgut|ileal|jejun|duoden|manure"),
    ("Oral / saliva", r"saliva|\boral\b|plaque|tongue|dental|gingiv|buccal|supragingival|subgingival|periodont|tooth|teeth|periapical"),
    ("Respiratory", r"sputum|lung|nasal|nasopharyn|oropharyn|airway|bronch|throat|respiratory|pharyn"),
    ("Vaginal / urogenital", r"vagin|cervic|urine|urinary|urethra|semen|penile|bladder|genital|reproductive tract"),
    ("Skin", r"\bskin\b|epiderm|forearm|elbow|axilla|sebum|scalp"),
    ("Milk", r"milk|colostrum"),
    ("Blood / plasma", r"blood|plasma|serum|cfrna"),
    ("Other host tissue / fluid", r"tissue|biopsy|organ|tumou?r|bile|liver|placenta|lesion|aqueous humor|synovial|csf|mucosa|swab of"),
    ("Invertebrate / host organism", r"\bbee\b|bumble|\bant\b|mosquito|\btick\b|\bfly\b|larva|insect|snail|isopod|sponge(?! biofilter)|coral|beetle|moth|nematode|daphnia|arthropod|midgut|shrimp|oyster"),
    ("In vitro culture / bioreactor", r"in vitro|culture|microcosm|mesocosm|bioreactor|chemostat|shime|synthetic (gut )?community|culture well|fermentation|activated sludge|reactor"),
    ("Food / fermented product", r"\bfood\b|ferment|cheese|brine|wine|beer|yogurt|meal|mash|silage|forage"),
    ("Plant / rhizosphere", r"rhizosphere|phyllosphere|\bleaf\b|leaves|\broot\b|\bseed\b|grain|flower|tomato|maize|wheat|\brice\b|plant|pepper|chili|poplar|endophyt|nodule"),
    ("Soil", r"\bsoil\b|permafrost|peat|compost"),
    ("Sediment", r"sediment"),
    ("Water / aquatic", r"water|seawater|marine|ocean|lake|river|effluent|wastewater|sludge|aquarium|groundwater|aquatic|biofilter|estuar"),
    ("Built environment / air", r"\bair\b|\bdust\b|surface|coupon|biofilm|shower|hospital|building|indoor"),
]
HOSTS = [
    ("Human", r"homo sapiens|\bhuman\b|\bman\b|patient|participant|infant|child|adult|women|men\b"),
    ("Mouse", r"\bmouse\b|\bmice\b|mus musculus|c57bl|balb/c|cba/j|5xfad|\bko\b mouse"),
    ("Rat", r"\brat\b|rattus|f344|fischer|sprague"),
    ("Pig", r"\bpig\b|swine|sus scrofa|piglet|porcine|boar"),
    ("Cattle / small ruminant", r"cattle|bovine|\bcow\b|bos taurus|sheep|ovis|goat|capra|calf|calves"),
    ("Poultry / bird", r"chicken|gallus|broiler|\bbird\b|poultry|duck|turkey|cockatiel|passerin|avian|penguin"),
    ("Fish", r"\bfish\b|salmon|trout|zebrafish|tilapia|carp\b"),
    ("Dog / cat", r"\bdog\b|canis|beagle|\bcat\b|feline"),
    ("Horse", r"horse|equus|equine|mare|foal"),
    ("Insect / arthropod", r"\bbee\b|bumble|\bant\b|mosquito|anopheles|aedes|\btick\b|drosophila|\bfly\b|insect|beetle|moth|larva|arthropod|sand ?fly|daphnia"),
    ("Other invertebrate", r"sponge|coral|snail|isopod|nematode|oyster|shrimp|mollusc|acropora"),
    ("Plant", r"plant|tomato|maize|wheat|\brice\b|poplar|pepper|chili|hevea|rubber tree|arabidopsis|barley|soybean|bean\b"),
    ("Other mammal", r"bat\b|monkey|macaque|primate|deer|rabbit|mammal|seal\b|whale"),
]
ENVIRONMENTS = [
    ("Environmental / none", r"\bsoil\b|sediment|\bwater\b|seawater|marine|ocean|lake|river|groundwater|effluent|wastewater|sludge|\bair\b|\bdust\b|permafrost|peat|compost|bioreactor|microcosm|mesocosm|chemostat|activated sludge|biofilter|aquarium|surface|coupon"),
]

# --------------------------------------------------------------------------
# diseases
# --------------------------------------------------------------------------
DISEASE_SYNONYMS = {
    "crc": "Colorectal cancer",
    "colorectal cancer": "Colorectal cancer",
    "colon cancer (colorectal cancer)": "Colorectal cancer",
    "adenoma": "Colorectal adenoma",
    "colorectal adenoma": "Colorectal adenoma",
    "cd": "Crohn's disease",
    "crohn's disease": "Crohn's disease",
    "uc": "Ulcerative colitis",
    "ulcerative colitis": "Ulcerative colitis",
    "inflammatory bowel disease": "Inflammatory bowel disease (unspecified)",
    "ibd": "Inflammatory bowel disease (unspecified)",
    "t2d": "Type 2 diabetes",
    "type 2 diabetes": "Type 2 diabetes",
    "t1d": "Type 1 diabetes",
    "type 1 diabetes": "Type 1 diabetes",
    "obesity": "Obesity",
    "diet-induced obesity": "Obesity (diet-induced)",
    "impaired glucose tolerance": "Impaired glucose tolerance",
    "parkinson": "Parkinson's disease",
    "parkinson's disease": "Parkinson's disease",
    "autism spectrum disorder": "Autism spectrum disorder",
    "asd": "Autism spectrum disorder",
    "ra": "Rheumatoid arthritis",
    "rheumatoid arthritis": "Rheumatoid arthritis",
    "cystic fibrosis": "Cystic fibrosis",
    "liver cirrhosis": "Liver cirrhosis",
    "psoriasis": "Psoriasis",
}
UNDEFINED_ABBREVIATIONS = ["ms", "me", "as", "bonedisease", "pd", "ad", "cf"]
DISEASE_CATEGORIES = [
    ("Cancer / neoplasm", r"cancer|carcinoma|tumou?r|adenoma|neoplas|myeloma|lymphoma"),
    ("Gastrointestinal", r"crohn|colitis|\bibd\b|inflammatory bowel|\bibs\b|constipation|celiac|coeliac|gastr|enteriti|diverticul"),
    ("Metabolic / hepatic", r"diabet|obesity|glucose|nafld|metabolic|cirrhosis|liver|steato|cholesterol"),
    ("Neurological / psychiatric", r"parkinson|alzheimer|autism|depress|anxiety|cognitive|dementia|sclerosis|encephalo|stroke|epilep|schizo"),
    ("Autoimmune / inflammatory", r"arthritis|psoriasis|spondyl|lupus|autoimmune|eczema|dermatitis|allerg"),
    ("Infection", r"infection|malaria|\bhiv\b|covid|salmonella|sars|tubercul|sepsis|challenge|helicobacter|clostridio|\bcdi\b|myiasis"),
    ("Respiratory", r"cystic fibrosis|pulmonary|asthma|copd|apnea|apnoea|bronch|respiratory"),
    ("Cardiovascular", r"cardiovascular|atheroscler|hypertens|cardiac|coronary"),
    ("Oral / dental", r"periodont|caries|gingiv|endodontic|periapical"),
    ("Urogenital", r"\buti\b|urinary|vagin|cervic|prostat|kidney|renal|stone"),
]
# status text of one sample; (label, pattern that must match, pattern that must match as well or None)
DISEASE_STATUS = [
    ("Not applicable (environmental / no disease design)", r"^(not applicable|n/?a\b|no disease design)", None),
    ("Control / healthy", r"^not label", r"\bctrl\b|0ctrl|control"),
    ("Not reported", r"^(not reported|not stated|not specified|unknown|not labelled|not labeled|no disease recorded|no label)", None),
    ("Control / healthy", r"^(healthy|control|normal|hc\b|ctrl\b|non-?case)", None),
    ("Case / disease", r"^(case|disease|patient|infected|challenged|affected)", None),
    ("Case / disease", r"patient|cancer|carcinoma|tumou?r|diabet|malaria|infect|challeng|diagnos|syndrome|\bitis\b|disorder|\bad\b|\bibd\b|\bibs\b|positive|severe", None),
    ("Control / healthy", r"healthy|control|normal", None),
]
UNLABELLED_STATUS = r"^(not reported|not applicable|unknown|not stated)"
# named diseases looked for in titles and abstracts; matched case-insensitively
DISEASE_MENTIONS = [
    ("Crohn's disease", r"\bcrohn(?:'s|s)? disease\b|\bCD patients?\b"),
    ("ulcerative colitis", r"\bulcerative colitis\b|\bUC patients?\b"),
    ("inflammatory bowel disease", r"\binflammatory bowel disease\b|\bIBD\b"),
    ("irritable bowel syndrome", r"\birritable bowel syndrome\b|\bIBS\b"),
    ("colorectal cancer", r"\bcolorectal (?:cancer|carcinoma)\b|\bcolon cancer\b|\bCRC\b"),
    ("gastric cancer", r"\bgastric (?:cancer|carcinoma)\b|\bstomach cancer\b"),
    ("liver cirrhosis", r"\b(?:liver|hepatic) cirrhosis\b"),
    ("non-alcoholic fatty liver disease", r"\bnon[- ]alcoholic fatty liver disease\b|\bNAFLD\b|\bNASH\b"),
    ("alcoholic liver disease", r"\balcohol(?:ic|-associated) liver disease\b"),
    ("type 1 diabetes", r"\btype 1 diabetes(?: mellitus)?\b|\bT1D\b"),
    ("type 2 diabetes", r"\btype 2 diabetes(?: mellitus)?\b|\bT2D\b"),
    ("obesity", r"\bobes(?:e|ity)\b"),
    ("HIV/AIDS", r"\bHIV(?:-1)?\b|\bAIDS\b|human immunodeficiency virus"),
    ("COVID-19", r"\bCOVID-?19\b|\bSARS-CoV-2\b"),
    ("autism spectrum disorder", r"\bautism spectrum disorder\b|\bASD\b"),
    ("Parkinson's disease", r"\bParkinson(?:'s|s)? disease\b"),
    ("Alzheimer's disease", r"\bAlzheimer(?:'s|s)? disease\b"),
    ("multiple sclerosis", r"\bmultiple sclerosis\b"),
    ("rheumatoid arthritis", r"\brheumatoid arthritis\b"),
    ("celiac disease", r"\b(?:celiac|coeliac) disease\b"),
    ("asthma", r"\basthma(?:tic)?\b"),
    ("atopic dermatitis", r"\batopic dermatitis\b|\beczema\b"),
    ("chronic kidney disease", r"\bchronic kidney disease\b|\bCKD\b"),
    ("cardiovascular disease", r"\bcardiovascular disease\b"),
    ("hypertension", r"\bhypertension\b"),
    ("periodontitis", r"\bperiodontitis\b|\bperiodontal disease\b"),
    ("necrotizing enterocolitis", r"\bnecrotizing enterocolitis\b|\bNEC\b"),
    ("cystic fibrosis", r"\bcystic fibrosis\b"),
    ("depression", r"\bmajor depressive disorder\b|\bdepression\b"),
    ("cancer", r"\b(?:cancer|carcinoma|tumou?r)\b"),
]

# --------------------------------------------------------------------------
# Paper screening (all case-insensitive)
# --------------------------------------------------------------------------
SCREEN_COMMUNITY = r"microbiom|microbiota|metagenom|virom|phageom|microbial community|bacterial community|viral community"
SCREEN_ASSAYS = [
    ("16S_amplicon", r"16s(?:\s+rrna)?|amplicon sequencing|v[1-9][\-–]?v[1-9]"),
    ("shotgun_metagenomics", r"shotgun metagenom|whole.metagenom|metagenomic sequencing"),
    ("viral_metagenomics", r"viral metagenom|virome sequencing|virus.like particle|\bvlp\b"),
    ("metatranscriptomics", r"metatranscriptom"),
]
SCREEN_PRODUCT = r"abundance|taxonomic profil|taxonomic composition|otu|asv|feature table|species profil|genus profil"
SCREEN_DATA = r"bioproject|sequence read archive|\bsra\b|\bena\b|mgnify|zenodo|figshare|dryad|supplement"
SCREEN_NOT_PRIMARY = r"\breview\b|systematic review|meta.analysis|editorial|commentary|protocol"
SCREEN_ISOLATE = r"complete genome|whole genome sequenc(?:e|ing).{0,30}(?:isolate|strain)|single isolate|genome announcement|outbreak surveillance"
SCREEN_HOST_ONLY = r"single.cell rna|scrna.seq|whole.exome|host transcriptom|poly\(a\).{0,20}rna.seq"

# --------------------------------------------------------------------------
# Accessions, links, repositories
# --------------------------------------------------------------------------
PROJECT_NUMBER = r"(?:\bbioproject\s*#?\s*|https?://(?:www\.)?ncbi\.nlm\.nih\.gov/bioproject/)(\d{4,10})\b"
ACCESSION_PATTERNS = [
    ("bioproject", r"\b(PRJ(?:NA|EB|DB|DA|CA)\d{4,10})\b"),
    ("bioproject", PROJECT_NUMBER),
    ("sra_study", r"\b([SED]RP\d{5,12})\b"),
    ("sra_run", r"\b([SED]RR\d{5,12})\b"),
    ("sra_experiment", r"\b([SED]RX\d{5,12})\b"),
    ("biosample", r"\b(SAM[NED][A-Z]?\d{4,14})\b"),
    ("mgnify_study", r"\b(MGYS\d{8,})\b"),
    ("mgnify_analysis", r"\b(MGYA\d{8,})\b"),
    ("arrayexpress", r"\b(E-MTAB-\d{2,8})\b"),
    ("biostudies", r"\b(S-(?:BSST|BIAD)\d{2,8})\b"),
    ("geo", r"\b(GSE\d{3,9})\b"),
    ("gsa", r"\b((?:CRA|HRA|PRJCA)\d{4,10})\b"),
    ("omix", r"\b(OMIX\d{3,8})\b"),
    ("zenodo", r"(?:10\.5281/zenodo\.|zenodo\.org/(?:record|records)/)(\d{3,})"),
    ("figshare", r"(?:10\.6084/m9\.figshare\.|figshare\.com/articles/\S*?/)(\d{5,})"),
    ("dryad", r"10\.5061/dryad\.([a-z0-9]+)"),
    ("mendeley", r"data\.mendeley\.com/datasets/([a-z0-9]+)"),
    ("osf", r"osf\.io/([a-z0-9]{5})\b"),
    ("github", r"github\.com/([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+)"),
]
CASE_KEPT_REPOSITORIES = ["zenodo", "figshare", "dryad", "mendeley", "osf", "github"]
TOOL_REPOSITORIES = [
    "raivokolde/pheatmap", "pmartinezarbizu/pairwiseadonis", "mikemc/speedyseq", "joey711/phyloseq",
    "benjjneb/dada2", "microbiome/microbiome", "jfq3/qsrutils", "vegandevs/vegan", "twbattaglia/btools",
    "zdk123/spieceasi", "hallucigenia-sparsa/seqtime", "biobakery/humann", "biobakery/metaphlan",
    "qiime2/qiime2", "ropensci/taxize",
]
URL_PATTERN = r"https?://[^\s<>\"']+"
URL_TRAILING = r"[.,;)\\\"\]]+$"
DATA_HOSTS = r"ncbi\.nlm\.nih\.gov|ebi\.ac\.uk|ena|mgnify|zenodo|figshare|dryad|mendeley|osf\.io|github\.com|dataverse"
BARE_DOI = r"(?<![/\w.])10\.(?:6084|5281|5061)/[^\s<>\"'\[\];,]+"
# platform, host pattern, registered DOI suffix (after the doi.org host) or None
PLATFORMS = [
    ("figshare", r"figshare", r"10\.6084/m9\.figshare\."),
    ("zenodo", r"(^|\.)zenodo\.org$", r"10\.5281/zenodo\."),
    ("Dryad", r"(^|\.)datadryad\.org$", r"10\.5061/dryad\."),
    ("OSF", r"(^|\.)osf\.io$", None),
    ("GitHub", r"(^|\.)github\.com$", None),
    ("NCBI", r"(^|\.)ncbi\.nlm\.nih\.gov$", None),
    ("EMBL-EBI", r"(^|\.)ebi\.ac\.uk$", None),
    ("DDBJ", r"(^|\.)ddbj\.nig\.ac\.jp$", None),
    ("NGDC GSA", r"^ngdc\.cncb\.ac\.cn$", None),
    ("CNGBdb", r"^db\.cngb\.org$", None),
    ("NMDC", r"(^|\.)nmdc\.cn$", None),
]
SEQUENCE_ARCHIVES = ["NCBI", "EMBL-EBI", "DDBJ", "NGDC GSA", "CNGBdb", "NMDC"]
ARCHIVE_NAMES = {"NCBI": "NCBI SRA", "EMBL-EBI": "ENA", "DDBJ": "DDBJ DRA"}
RAW_READ_ACCESSION = r"\b(?:PRJNA\d+|PRJEB\d+|PRJDB\d+|[SED]R[APRSX]\d+|SAMN\d+|CRA\d+|CNP\d+)\b"
ARCHIVE_CONTEXT = r"\bSRA\b|\b(?:Sequence|Short) Read Archive\b|\bNCBI\b|\bBioProject\b|\bGenBank\b|\bNational Center for Biotechnology Information\b|\bEuropean Nucleotide Archive\b"
DRA_RESOURCES = {"DRA": "sra-submission", "DRP": "sra-study", "DRR": "sra-run", "DRX": "sra-experiment", "DRS": "sra-sample"}
AVAILABILITY_TITLE = r"data|code|availability|accession"
STRICT_AVAILABILITY_TITLE = (
    r"data[\s_-]*(?:availability|accessibility)|availability\s+of\s+(?:supporting\s+)?data"
    r"|(?:data|dna)\s+deposition|data\s+records|data\s+summary|accession\s+codes?"
)
STRICT_DATA_TITLE = r"(?:associated[\s_-]+)?data"
DEPOSIT_SENTENCE = (
    r"\b(?:deposited|submitted|archived)\b|sequenc(?:e|ing) data .{0,60}available (?:at|from|in)\b|\baccession codes?\b"
)
SUPPORTING_TITLE = r"supporting\s+information|supplementary\s+(?:information|materials?|data)"
SKIPPED_PRODUCT_CHUNK = r"previous study|isolate genome|isolate 16s|not abundance|reference genome|assembled genome|genbank"
SUPPORTED_ACCESSION = r"\b(?:PRJNA\d+|PRJEB\d+|PRJDB\d+|SRP\d+|ERP\d+|DRP\d+|SRR\d+|ERR\d+|DRR\d+|SAMN\d+|SAMEA\d+|SAMD\d+)\b"
UNSUPPORTED_ACCESSION = r"\b(?:CRA\d+|PRJCA\d+|SUB\d+)\b"
ACCESSION_RANGE = r"\b(PRJNA|PRJEB|PRJDB|SRR|ERR|DRR)(\d+)-(?:\1)?(\d+)\b"

# --------------------------------------------------------------------------
# Dataset and paper candidates (case-insensitive)
# --------------------------------------------------------------------------
ABUNDANCE_FILE = r"abundance|relative.abund|taxonomic.profile|taxonomy.*table|feature.table|otu.table|asv.table|zotu|\.biom(?:\.|$)|\.qza(?:\.|$)|bracken|kraken|metaphlan|centrifuge|kaiju|species.profile|genus.profile|phylum.profile|viral.profile|community.composition"
READ_FILE = r"\.f(?:ast)?q(?:\.gz)?$|fastq_ftp|\.sra$"
TABLE_FILE = r"\.(?:xlsx|xls|csv|tsv|txt|tab)(?:!|$)"
SEQUENCE_REPOSITORIES = ["bioproject", "sra_study", "sra_run", "sra_experiment", "mgnify_study", "mgnify_analysis", "gsa"]
PROCESSED_REPOSITORIES = ["figshare", "zenodo", "dryad", "osf", "europepmc_supp", "mendeley"]
COMMUNITY_ASSAY = r"16S_amplicon|shotgun_metagenomics|viral_metagenomics|metatranscriptomics"
WRONG_ASSAY = r"isolate_or_single_genome|host_only_assay"
DATA_CATEGORIES = {
    "abundance_ready": "processed", "needs_content_check": "processed", "raw_reads_ready": "raw_reads",
    "raw_reads_needs_assay_check": "raw_reads", "manual_review": "unknown", "no_data_link_found": "unknown",
}
TEXT_PROFILERS = [
    ("QIIME2", r"\bqiime\s?2\b|\.qza(?:\.|$)|\.qzv(?:\.|$)"),
    ("QIIME1", r"\bqiime\b(?!\s?2)"),
    ("mothur", r"\bmothur\b"),
    ("DADA2", r"\bdada2\b"),
    ("USEARCH/UPARSE", r"\busearch\b|\buparse\b"),
    ("VSEARCH", r"\bvsearch\b"),
    ("MetaPhlAn", r"\bmetaphlan\d?\b"),
    ("Kraken/Bracken", r"\bkraken\d?\b|\bbracken\b"),
    ("Kaiju", r"\bkaiju\b"),
    ("Centrifuge", r"\bcentrifuge\b"),
    ("HUMAnN", r"\bhumann\d?\b"),
    ("PICRUSt2", r"\bpicrust\d?\b"),
    ("LotuS2", r"\blotus\d?\b"),
    ("MEGAN", r"\bmegan\b"),
    ("MG-RAST", r"\bmg-?rast\b"),
    ("phyloseq", r"\bphyloseq\b"),
]
FILE_PROFILERS = [
    ("QIIME2", r"\bqiime\s?2\b|\.qza(?:!|\.|$)|\.qzv(?:!|\.|$)|feature-table"),
    ("QIIME1", r"\bqiime\b(?!\s?2)"),
    ("mothur", r"\bmothur\b"),
    ("DADA2", r"\bdada2\b|seqtab"),
    ("USEARCH/UPARSE", r"\busearch\b|\buparse\b|\bzotu"),
    ("VSEARCH", r"\bvsearch\b"),
    ("MetaPhlAn", r"\bmetaphlan\d?\b"),
    ("Kraken/Bracken", r"\bkraken\d?\b|\bbracken\b"),
    ("Kaiju", r"\bkaiju\b"),
    ("Centrifuge", r"\bcentrifuge\b"),
    ("HUMAnN", r"\bhumann\d?\b"),
    ("PICRUSt2", r"\bpicrust\d?\b"),
    ("LotuS2", r"\blotus\d?\b"),
    ("MEGAN", r"\bmegan\b"),
    ("phyloseq", r"\bphyloseq\b"),
    (".biom format", r"\.biom(?:!|\.|$)"),
]
BLOCKED_RETRY = r"timeout|BrokenPipeError|Internal Server Error|Service Temporarily Unavailable|end-of-stream marker|ConnectionResetError|ConnectionError|list_deposit_files error"
BLOCKED_NOT_DATA = r"classifier\.qza$|_R[12][_.]|_mpg_data_|\.fastq(\.gz)?$|\.fq(\.gz)?$|_a[a-z]\.gz$"
BLOCKED_MANUAL = r"anti[ _-]?bot|Forbidden|format cannot be determined"
BLOCKED_CLASSES = ["0_no_dataset_linked", "1_retry_transient", "2_skip_not_real_data", "3_manual_check", "4_uncategorized"]
CHALLENGE_SIGNATURES = ["<html", "<!DOCTYPE", "cloudpmc", "Preparing to download"]

# --------------------------------------------------------------------------
# Deposited tables (case-insensitive)
# --------------------------------------------------------------------------
TAXON_TEXT = (
    r"(^|[;|,\s])[kpcofgsd]__"
    r"|;\s*[A-Z][a-z]{2,}"
    r"|(aceae|ales|bacteria|bacteriota|archaea|mycota|virales|viridae|"
    r"coccus|bacillus|monas|bacter|vibrio|spirillum|clostridium|prevotella|"
    r"bacteroides|lactobacillus|firmicutes|proteobacteria|actinobacteri|"
    r"verrucomicrobi|bifidobacterium|akkermansia|faecalibacterium)"
    r"|^(otu|asv|zotu|sv)[_ -]?\d+"
)
RANK_HEADERS = [
    "kingdom", "domain", "superkingdom", "phylum", "class", "order", "family", "genus", "species", "taxon",
    "taxonomy", "otu", "asv", "otu_id", "asv_id", "feature id", "featureid", "#otu id", "lineage", "clade", "taxa",
]
ABUNDANCE_HEADER = r"(abundance|relative[_ ]?abund|count|reads|freq|rpkm|tpm|cpm|value|proportion)"
SAMPLE_HEADER = r"(sample|subject|specimen|run|library|host|individual)"
MIN_TAXA_FRACTION = 0.50
REVIEW_TAXA_FRACTION = 0.30
READ_FILE_NAME = r"\.(?:fastq|fq|bam|sam|sra)(?:\.gz)?$"
TWO_SLASHES = r"[/\\].*[/\\]"
RANK_PREFIX = r"^[kpcofgsd](_[a-z])?__"
VIRUS_TEXT = r"(?:virus|viridae|virales|phage)"
PROKARYOTE_TEXT = (
    r"(?:(?<![A-Za-z])bacteria(?![A-Za-z])|(?<![A-Za-z])archaea(?![A-Za-z])|"
    r"bacteriota|proteobacteria|firmicutes|bacteroidetes|bacteroidota|actinobacteri|cyanobacteria|verrucomicrobi|"
    r"spirochaet|chlamydiae|tenericutes|fusobacteri|euryarchaeota|crenarchaeota|thaumarchaeota|"
    r"(?<![A-Za-z])coccus(?![A-Za-z])|(?<![A-Za-z])bacillus(?![A-Za-z])|(?<![A-Za-z])monas(?![A-Za-z])|"
    r"(?<![A-Za-z])bacter(?![A-Za-z])|(?<![A-Za-z])vibrio(?![A-Za-z])|(?<![A-Za-z])spirillum(?![A-Za-z])|"
    r"(?<![A-Za-z])clostridium(?![A-Za-z])|(?<![A-Za-z])prevotella(?![A-Za-z])|(?<![A-Za-z])bacteroides(?![A-Za-z])|"
    r"(?<![A-Za-z])lactobacillus(?![A-Za-z])|(?<![A-Za-z])bifidobacterium(?![A-Za-z])|"
    r"(?<![A-Za-z])akkermansia(?![A-Za-z])|(?<![A-Za-z])faecalibacterium(?![A-Za-z]))"
)
CONTROL_SAMPLE = r"(?:^|[_\-\s])(?:blank|ntc|neg(?:ctrl|[_\-]?control)?|mock|zymo|pos(?:ctrl|[_\-]?control)?|extraction[_\-]?control)\d*(?:$|[_\-\s])"
SEQUENCING_HINT = r"(16s|18s|its\d?|coi|wgs|shotgun|metagenom|metatranscript)"
# text a table reader treats as missing
MISSING_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
TRIAGE_TEXT = [
    ("functional_summary", r"number of gene hits|kegg level|brite hierarchies"),
    ("statistical_summary", r"\bp[- _]?value\b|\badjusted p\b|\bpadj\b|\bstandard deviation\b|\bstandard error\b"),
    ("sequencing_summary", r"clean reads|filtered reads|q20|q30|sequencing depth"),
]
TRIAGE_ABUNDANCE = r"abundance|otu|asv|rpkm|tpm|count.matrix|taxonomic.profile"

# --------------------------------------------------------------------------
# Viral dataset
# --------------------------------------------------------------------------
VIRAL_RANKS = ["realm", "kingdom", "phylum", "class", "order", "family", "genus", "species"]
SAMPLE_COLUMNS = ["sample_type", "host", "subject_id", "disease", "disease_name", "disease_status", "experimental_group",
                  "timepoint", "measurement_method", "batch", "is_pooled_sample", "abundance_unit"]
DISEASE_COLUMNS = ["disease", "disease_name", "disease_label_original", "paper_cohort_name", "group_description"]
LABEL_COLUMN = r"disease|cohort|diagnos|condition|group|phenotype|clinical|salinity|treatment"
NO_LABEL_VALUE = r"^(not |none$|n/?a$|unknown)"
ALWAYS_ANSWERABLE = ["prevalence", "alpha/beta diversity", "co-occurrence", "vOTU catalogue"]
DEFAULT_RECOVERY = "incidental: viruses reported by a bacterial profiler"

# --------------------------------------------------------------------------
# Reads, primers, branches, claims, registry
# --------------------------------------------------------------------------
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC",
         "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
COMPLEMENT = ("ACGTRYSWKMBVDHN", "TGCAYRSWMKVBHDN")
PRIMERS = {
    "16S_V1V3": ("AGAGTTTGATCMTGGCTCAG", "ATTACCGCGGCTGCTGG"),
    "16S_V3V4": ("CCTACGGGNGGCWGCAG", "GACTACHVGGGTATCTAATCC"),
    "16S_V4": ("GTGYCAGCMGCCGCGGTAA", "GGACTACNVGGGTWTCTAAT"),
    "ITS1": ("CTTGGTCATTTAGAGGAAGTAA", "GCTGCGTTCTTCATCGATGC"),
    "ITS2": ("GCATCGATGAAGAACGCAGC", "TCCTCCGCTTATTGATATGC"),
    "18S_V4": ("CCAGCASCYGCGGTAATTCC", "ACTTTCGTTCTTGATYRA"),
    "18S_V9": ("GTACACACCGCCCGTC", "TGATCCTTCTGCAGGTTCACCTAC"),
}
PRIMER_STARTS = [
    ("16S V1-V3 (27F)", "AGAGTTTGATC"), ("16S V3-V4 (341F)", "CCTACGGG"), ("16S V4 (515F)", "GTGYCAGC"),
    ("ITS1 (ITS1F)", "CTTGGTCATTTAG"), ("ITS2 (ITS3)", "GCATCGATGAAGAACGCAGC"),
]
FLOW_CELL = r"[A-Za-z0-9_-]+:[0-9]+:[A-Za-z0-9-]+:[0-9]+:"
MARKER_BRANCHES = {
    "16S_V1V3": "amplicon_16s", "16S_V3V4": "amplicon_16s", "16S_V4": "amplicon_16s",
    "ITS1": "amplicon_its", "ITS2": "amplicon_its", "18S_V4": "amplicon_18s", "18S_V9": "amplicon_18s",
}
VIRAL_SELECTION = ["VIRAL", "SIZE FRACTIONATION", "VIRUS"]
UNIMPLEMENTED_BRANCHES = ["rna", "amplicon_its", "amplicon_18s", "amplicon_other", "unsupported_isolate_genome"]
DEFERRED_STATUSES = ["missing_dependencies", "unsupported"]
CONFIDENCE_LEVELS = ["confirmed", "inferred", "unknown"]
REQUIRED_CLAIM_FIELDS = ["paper_sample_id", "experimental_group"]
CLAIM_FIELDS = ["paper_sample_id", "experimental_group", "disease", "disease_state", "treatment", "timepoint", "subject_id",
                "replicate_of", "sample_type", "body_site", "host_species", "sex", "age", "geographic_location", "collection_date"]
CLAIM_ALIASES = {"tissue": "body_site", "bodysite": "body_site", "host": "host_species", "group": "experimental_group"}
MISSING_WORDS = ["", "missing", "na", "n/a", "none", "unknown"]
UNRESOLVED, NOT_REPORTED, NOT_APPLICABLE = "unresolved", "not_reported", "not_applicable"
KEY_FACTS = ["host", "body_site", "design"]
FINISHED_STATUSES = ["done", "done_quantification_only", "done_partial"]
FAILED_STATUSES = ["failed", "metadata_blocked", "no_space", "skipped_unsuitable"]
BRANCH_METHODS = {"amplicon_16s": "16s_paired", "amplicon_16s_single": "16s_single",
                  "dna_shotgun_bacteria": "shotgun_bacteria", "viral_mapping": "viral_mapping"}
RISK_ORDER = ["no_grouping", "noisy_rare_asvs", "partial_branches"]
MIN_CHIMERA_RETENTION = 0.80
MIN_MERGE_RETENTION = 0.30
MAX_EMPTY_SHARE = 0.05
MIN_READS = 1000
MIN_MODEL_BASES = 1e8
MIN_OVERLAP = 12
MIN_BREADTH, MIN_DEPTH = 0.75, 1.0
