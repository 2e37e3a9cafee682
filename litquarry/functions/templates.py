"""Prompt texts. Results carry them word for word."""

EXTRACTION_PROMPT = """Analyze the abstract below and extract disease and gene information. Only include explicitly stated facts. Use "n/a" if information is not clearly provided. Do not infer or guess. Respond in this exact JSON format:
{
  "Disease": "Disease name or n/a",
  "Genes": "Gene1, Gene2, Gene3 or n/a"
}

Rules:
- Only include explicitly stated disease and genes
- List all genes as a comma-separated string in the Genes field
- Use "n/a" if no disease or genes are mentioned
- Prioritize precision over completeness
- When in doubt, use "n/a"
- Do not include any additional fields or comments

Examples:
{"Disease": "n/a", "Genes": "TP53, MDM2"}

{"Disease": "n/a", "Genes": "n/a"}

{"Disease": "Lung Cancer", "Genes": "n/a"}

{"Disease": "Breast Cancer", "Genes": "BRCA1, BRCA2"}

{"Disease": "Colorectal Cancer", "Genes": "APC"}



Abstract:
<abstract>
[[[abstract]]]
</abstract>"""

GENERAL_TOPICS = [
    "General Diagnostic Methods", "Imaging Techniques", "Molecular Diagnostics",
    "Biomarker Discovery", "Point-of-Care Testing", "Laboratory Techniques",
    "Histopathology", "Liquid Biopsy", "Genomic Sequencing", "Proteomics",
    "General Oncology - No Specific Cancer Type",
]

NEGATIVE_SYSTEM = "You are a medical research assistant specializing in oncology and general medical research. Create concise, realistic abstracts about diagnostic techniques, treatment approaches, clinical trials, and research methods without mentioning specific genes, biomarkers, or molecular targets. Use general terms to discuss biological aspects."

# Placeholders in order: topic, diagnostic scope, treatment scope, trial scope, methodology word.
NEGATIVE_PROMPT = """Generate a 250-350 character abstract about research related to %s. 
    Choose one of the following focus areas:
    1. A diagnostic method or technique %s.
    2. The effects of a novel treatment approach %s.
    3. Results from a recent clinical trial %s.
    4. Advancements in %s research methodology.

    Focus on recent developments, improvements in patient outcomes, or potential clinical applications. 
    Do not mention any specific genes, biomarkers, or molecular targets. 
    Use general terms like 'genetic markers', 'protein indicators', or 'molecular pathways' if necessary."""

CANCER_PHRASES = ["for this cancer type", "for this cancer", "for this cancer type", "cancer"]
GENERAL_PHRASES = ["in medical research", "in this field", "in this area of medical research", "medical"]
