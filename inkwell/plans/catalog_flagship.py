"""J8 enrichment record; its oracle composes the oracles of its parts."""

from __future__ import annotations

from inkwell.plans import flagship as FS
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import ORACLES, register


def _oracle() -> str:
    return with_views(f"""
  SELECT a.article_id, l.language, a.target_keyword,
         CASE WHEN a.target_keyword IS NULL OR a.target_keyword = '' THEN 'failed' ELSE 'continue' END AS outcome,
         s.headings, s.corrected, coalesce(c.structure_source, 'none') AS structure_source,
         coalesce(c.h2_topics, '') AS h2_topics, f.max_similarity, f.plagiarism_flagged,
         md5(r.normalized_html) AS normalized_md5, coalesce(k.l, '') AS secondary_keywords, o.content_score
  FROM v_articles a
  JOIN ({ORACLES['heading_rewrite']}) r USING (article_id)
  LEFT JOIN (SELECT seed, string_agg(keyword, ' | ' ORDER BY rank) AS l FROM ({ORACLES['topic_keywords']}) GROUP BY seed) k
    ON k.seed = a.target_keyword
  LEFT JOIN ({ORACLES['poll_first_done']}) o ON o.doc_id = a.article_id
  JOIN ({ORACLES['detect_language']}) l USING (article_id)
  JOIN ({ORACLES['heading_skips']}) s USING (article_id)
  JOIN ({ORACLES['similarity_flag']}) f USING (article_id)
  LEFT JOIN ({ORACLES['competitor_fallback']}) c ON c.keyword = a.target_keyword""", "v_articles")


register("enrichment_star", _oracle())(FS.enrichment_star)
