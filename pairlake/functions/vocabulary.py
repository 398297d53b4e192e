"""Word lists and lookup tables that results depend on."""

from __future__ import annotations

# URL slug -> category, in the order in which equally long slugs are tried.
SLUGS = {
    "botulinum-toxin": "botox", "botox": "botox", "botox-cosmetic": "botox", "dysport": "botox", "xeomin": "botox", "jeuveau": "botox", "daxi": "botox",
    "lip-augmentation": "lip_filler", "lip-augmentation---enhancement": "lip_filler", "lip-enhancement": "lip_filler", "lip-filler": "lip_filler", "lip-fillers": "lip_filler",
    "dermal-fillers": "dermal_filler", "dermal-filler": "dermal_filler", "fillers": "dermal_filler", "juvederm": "dermal_filler", "restylane": "dermal_filler",
    "sculptra": "dermal_filler", "radiesse": "dermal_filler", "belotero": "dermal_filler", "cheek-augmentation": "dermal_filler", "cheek-filler": "dermal_filler", "cheek-fillers": "dermal_filler",
    "chin-augmentation": "jawline_filler", "chin-filler": "jawline_filler", "chin-implants": "jawline_filler", "jawline-filler": "jawline_filler",
    "under-eye-filler": "under_eye_filler", "tear-trough": "under_eye_filler", "kybella": "kybella",
    "facelift": "facelift", "face-lift": "facelift", "mini-facelift": "facelift", "brow-lift": "facelift", "browlift": "facelift", "forehead-lift": "facelift", "neck-lift": "facelift", "necklift": "facelift",
    "eyelid-surgery": "blepharoplasty", "blepharoplasty": "blepharoplasty", "upper-blepharoplasty": "blepharoplasty", "lower-blepharoplasty": "blepharoplasty",
    "upper-eyelid-surgery": "blepharoplasty", "lower-eyelid-surgery": "blepharoplasty", "rhinoplasty": "rhinoplasty", "nose-surgery": "rhinoplasty", "nose-reshaping": "rhinoplasty",
    "otoplasty": "otoplasty", "ear-surgery": "otoplasty", "fat-transfer-to-face": "fat_transfer", "fat-transfer": "fat_transfer",
    "laser-skin-resurfacing": "laser_resurfacing", "laser-resurfacing": "laser_resurfacing", "laser-treatment": "laser_resurfacing", "chemical-peel": "chemical_peel", "chemical-peels": "chemical_peel",
    "microneedling": "microneedling", "thread-lift": "thread_lift", "microdermabrasion": "microdermabrasion", "ipl-photofacial": "ipl_photofacial", "ipl": "ipl_photofacial", "prp": "prp", "platelet-rich-plasma": "prp",
}

# Community name -> category.
COMMUNITIES = {
    "rhinoplasty": "rhinoplasty", "jawsurgery": "jawline_filler", "facialplasticsurgery": "facelift", "eyelidsurgery": "blepharoplasty",
    "fillers": "dermal_filler", "injectables": "dermal_filler", "botox": "botox",
}

# Categories by how specific they are; others count 0.
PRIORITY = {
    "lip_filler": 3, "cheek_filler": 3, "under_eye_filler": 3, "jawline_filler": 3, "rhinoplasty": 2, "blepharoplasty": 2, "facelift": 2, "thread_lift": 2,
    "laser_resurfacing": 2, "chemical_peel": 2, "microneedling": 2, "prp": 2, "kybella": 2, "botox": 2, "dermal_filler": 1,
}

# Fixed values: (pattern, category, brand) of text rules, in order.
TEXT_RULES = [
    (r"\b(botox|btx)\b", "botox", "Botox"),
    (r"\bdysport\b", "botox", "Dysport"),
    (r"\bxeomin\b", "botox", "Xeomin"),
    (r"\b(daxxify|revance)\b", "botox", "Daxxify"),
    (r"\b(neurotoxin|neuromodulator|wrinkle[\s\-]?relaxer)\b", "botox", None),
    (r"\bvolbella\b", "lip_filler", "Juvederm Volbella"),
    (r"\b(lip[\s\-]?filler|lip[\s\-]?augment|lip[\s\-]?inject|lip[\s\-]?plump)\b", "lip_filler", None),
    (r"\bvoluma\b", "cheek_filler", "Juvederm Voluma"),
    (r"\b(cheek[\s\-]?filler|cheek[\s\-]?augment|malar[\s\-]?filler)\b", "cheek_filler", None),
    (r"\b(tear[\s\-]?trough|under[\s\-]?eye[\s\-]?filler|restylane[\s\-]?eyelight)\b", "under_eye_filler", None),
    (r"\b(jawline[\s\-]?filler|jaw[\s\-]?filler|chin[\s\-]?filler)\b", "jawline_filler", None),
    (r"\bjuvederm\b", "dermal_filler", "Juvederm"),
    (r"\brestylane\b", "dermal_filler", "Restylane"),
    (r"\bsculptra\b", "dermal_filler", "Sculptra"),
    (r"\bradiesse\b", "dermal_filler", "Radiesse"),
    (r"\bbelotero\b", "dermal_filler", "Belotero"),
    (r"\b(rha[\s\-]?collection|revanesse)\b", "dermal_filler", None),
    (r"\bdermal[\s\-]?filler\b", "dermal_filler", None),
    (r"\b(rhinoplasty|nose[\s\-]?job|nose[\s\-]?reshap|rhinoplast)\b", "rhinoplasty", None),
    (r"\b(liquid[\s\-]?nose|non[\s\-]?surgical[\s\-]?nose|non[\s\-]?surgical[\s\-]?rhinoplasty)\b", "rhinoplasty", None),
    (r"\b(blepharoplasty|eyelid[\s\-]?surgery|eye[\s\-]?lift)\b", "blepharoplasty", None),
    (r"\b(facelift|face[\s\-]?lift|rhytidectomy|mini[\s\-]?lift)\b", "facelift", None),
    (r"\bthread[\s\-]?lift\b", "thread_lift", None),
    (r"\b(laser[\s\-]?resurfac|co2[\s\-]?laser|fraxel|clear[\s\-]?lift|halo[\s\-]?laser)\b", "laser_resurfacing", None),
    (r"\b(chemical[\s\-]?peel|glycolic[\s\-]?peel|vi[\s\-]?peel|tca[\s\-]?peel)\b", "chemical_peel", None),
    (r"\bmicroneedl\w*\b", "microneedling", None),
    (r"\b(prp|platelet[\s\-]?rich[\s\-]?plasma)\b", "prp", None),
    (r"\b(kybella|deoxycholic)\b", "kybella", None),
    (r"보톡스", "botox", "Botox"),
    (r"립\s*필러", "lip_filler", None),
    (r"필러", "dermal_filler", None),
    (r"\b(preenchimento[\s\-]?labial|preenchimento[\s\-]?l[aá]bio)\b", "lip_filler", None),
    (r"\b(toxina[\s\-]?botul[ií]nica|aplica[cç][aã]o[\s\-]?botox)\b", "botox", None),
    (r"\bpreenchimento\b", "dermal_filler", None),
]

# Words that say which side of a pair a text or an attribute speaks of.
BEFORE_WORDS = [
    "before", "pre-treatment", "pre treatment", "pretreatment", "prior to", "untreated", "baseline", "pre-op", "preop", "전", "시술전", "치료전", "이전", "수술전",
    "antes", "pré-tratamento", "pre-tratamento", "antes do", "anterior", "pre tratamento",
]
AFTER_WORDS = [
    "after", "post-treatment", "post treatment", "posttreatment", "results", "outcome", "following", "post-op", "postop", "result", "after care",
    "후", "시술후", "치료후", "이후", "결과", "수술후", "depois", "após", "pós-tratamento", "pos-tratamento", "resultado", "resultado final", "pós", "pos tratamento",
]
BEFORE_TEXT = ["before", "pre-treatment", "pretreatment", "prior to", "untreated", "baseline", "전", "시술전", "치료전", "이전", "수술전", "antes", "pré-tratamento", "anterior"]
AFTER_TEXT = ["after", "post-treatment", "posttreatment", "results", "outcome", "following", "post-op", "후", "시술후", "치료후", "이후", "결과", "depois", "após", "pós-tratamento", "resultado"]

# Instruction per category.
PROMPTS = {
    "botox": "Apply botulinum toxin to smooth forehead lines and glabellar frown lines",
    "lip_filler": "Apply hyaluronic acid filler to enhance lip volume and definition",
    "cheek_filler": "Apply hyaluronic acid filler to add volume to the cheeks and malar area",
    "under_eye_filler": "Apply hyaluronic acid filler to the tear trough to reduce under-eye hollows",
    "jawline_filler": "Apply filler to define and contour the jawline",
    "dermal_filler": "Apply dermal filler to restore facial volume",
    "rhinoplasty": "Apply non-surgical rhinoplasty to reshape the nose",
    "blepharoplasty": "Apply eyelid treatment to refresh the periorbital area",
    "facelift": "Apply facial rejuvenation treatment to lift and tighten",
    "thread_lift": "Apply thread lift for non-surgical facial lifting",
    "laser_resurfacing": "Apply laser resurfacing to improve skin texture and tone",
    "chemical_peel": "Apply chemical peel to improve skin tone and reduce fine lines",
    "microneedling": "Apply microneedling to stimulate collagen and improve skin texture",
    "prp": "Apply PRP treatment for facial rejuvenation and skin quality",
    "kybella": "Apply Kybella to reduce submental fat under the chin",
}
DEFAULT_PROMPT = "Apply aesthetic facial treatment"

# Zones that matter for a category.
ZONES_OF = {
    "botulinum_toxin": ["forehead_lines", "glabellar_complex", "brow_position", "crow_feet"],
    "botox": ["forehead_lines", "glabellar_complex", "brow_position"],
    "dysport": ["forehead_lines", "glabellar_complex"],
    "lip_filler": ["lips", "perioral_lines"],
    "cheek_filler": ["cheek_malar", "midface_volume"],
    "nasolabial_filler": ["nasolabial_folds"],
    "chin_filler": ["chin"],
    "jawline_filler": ["jawline"],
    "masseter_botox": ["masseter"],
    "tear_trough_filler": ["periorbital"],
    "temporal_filler": ["temporal_region"],
    "nose_filler": ["nose"],
    "neck_botox": ["platysmal_bands", "neck_laxity"],
    "skin_booster": ["skin_texture", "overall_skin_tone"],
}

# Landmark numbers of the irises and of the two eyes' contours.
IRISES = (468, 473)
LEFT_EYE = [33, 7, 163, 144, 145, 153, 154, 155, 133, 173, 157, 158, 159, 160, 161, 246]
RIGHT_EYE = [362, 382, 381, 380, 374, 373, 390, 249, 263, 466, 388, 387, 386, 385, 384, 398]
